"""lakegov — governed lakehouse analytics as Spark DataFrame / SQL operators.

Layers: raw -> validated (+ quarantine) -> curated; master data matching,
steward status, SCD2 golden tables and snapshots; a star schema with the
standard analytic queries; data-quality metrics, assertions and governance
gates. Every operator is a function from DataFrames to a DataFrame.
"""

from lakegov.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
