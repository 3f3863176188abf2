"""Which training-data queries are held against SQL, and that all stand in the driver contract."""

import __spark_entry__ as E
from lakegov.llm import catalog


def test_queries_are_registered():
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.ORACLES) <= set(E.oracle_sql())
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]
    assert set(catalog.ORACLES) == {"op3_risk_controlled_rules", "op6_line_dedup", "op7_poisson_mix", "op12_conversation_trie"}
