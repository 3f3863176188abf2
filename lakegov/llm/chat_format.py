r"""Chat formatting in budgeted windows (native DataFrame functions only).

A conversation's turns are ordered by turn number and costed in tokens (word
and punctuation pieces of the text plus the marks). The leading system turn is
retained in every window. The other turns are laid on one line by the prefix
sums of their tokens and cut into spans of at most the window's free budget:
turn-aligned, at fixed multiples of the budget, so every turn finds its span
from its own prefix sum without looking at the spans before. Before a span
the last turns that fit in the history budget are repeated as context; they
and the system turn are masked, so each assistant text carries the loss once.

Template: ``<|im_start|>role\ntext<|im_end|>\n`` per turn. Texts and roles are
escaped reversibly: a backslash is doubled, ``<|`` becomes ``<\|`` (a mark can
thus never occur inside a text), and a newline in a role becomes ``<|nl|>``.

Defined cases: a null text or role is empty; null turn numbers come first and
equal ones are ordered by role, then text; repeated rows are turns of their
own; null conversation ids form one conversation; a turn larger than the
budget is a span of its own and its window is marked ``over_budget``; a later
system turn is an ordinary turn; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
START, END, NL = "<|im_start|>", "<|im_end|>\n", "<|nl|>"
MARK_TOKENS = 4


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NL))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NL), F.lit("\n")))


def turn_tokens(text: Column) -> Column:
    """An estimate of a turn's tokens: pieces of letters and digits, or single other marks, plus the template's own."""
    return (F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]")) + MARK_TOKENS).cast("long")


def turns(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: str | None = None) -> DataFrame:
    """One row per turn: position, tokens, its span, and on the first turn of a
    window the turns repeated before it (``hist``, at most ``history /
    MARK_TOKENS``) and the retained system turn (``sys``, at most one). ``tokens``
    names a column with the texts' exact token counts (such as those of
    ``token_prefix``); without it ``turn_tokens`` estimates them. A conversation
    streams through one sort; nothing of it is gathered beyond ``history``."""
    cost = turn_tokens(F.coalesce("text", F.lit(""))) if tokens is None else (F.coalesce(tokens, F.lit(0)) + MARK_TOKENS).cast("long")
    c = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                             F.coalesce("text", F.lit("")).alias("text"), cost.alias("tokens"))
    conv = Window.partitionBy("conv_id")
    c = c.withColumn("pos", F.row_number().over(conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")).cast("long"))
    c = c.withColumn("retained", (F.col("pos") == 1) & (F.col("role") == "system"))
    c = c.withColumn("_line", F.when(F.col("retained"), F.lit(0).cast("long")).otherwise(F.col("tokens")))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    c = c.withColumn("piece", F.concat(head, escape(F.col("text")), F.lit(END)))
    c = c.withColumn("item", F.struct(
        "pos", "tokens", "piece", F.char_length("piece").cast("long").alias("size"),
        F.when(F.col("role") == "assistant", F.struct(
            F.char_length(head).cast("long").alias("at"),
            F.char_length(escape(F.col("text"))).cast("long").alias("length"))).alias("target")))
    so_far = conv.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("upto", F.sum("_line").over(so_far))
    c = c.withColumn("sys", F.max(F.when(F.col("retained"), F.col("item"))).over(so_far))
    c = c.withColumn("start", F.col("upto") - F.col("_line"))
    before = conv.orderBy("start").rangeBetween(-history, -1)
    c = c.withColumn("hist", F.sort_array(F.collect_list(F.when(~F.col("retained"), F.col("item"))).over(before)))
    # Cells of `_room` tokens: turns inside one cell are a span, a turn across a border is a span of its own.
    c = c.withColumn("_room", F.greatest(F.lit(budget - history).cast("long") - F.coalesce("sys.tokens", F.lit(0)),
                                         F.lit(1).cast("long")))
    crosses = F.expr("start div _room <> greatest(upto - 1, start) div _room")
    c = c.withColumn("span", F.expr("2 * (start div _room)") + F.when(crosses, F.lit(1)).otherwise(F.lit(0)))
    # the system turn stands before the first span
    c = c.withColumn("span", F.when(F.col("retained"), F.coalesce(F.lead("span").over(conv.orderBy("pos")), F.lit(0)))
                     .otherwise(F.col("span")))
    # repeated turns and the system turn go on with the first turn of a window alone
    opens = ~F.col("span").eqNullSafe(F.lag("span").over(conv.orderBy("pos")))
    c = c.withColumn("_opens", opens)
    c = c.withColumns({"hist": F.when(F.col("_opens"), F.col("hist")), "sys": F.when(F.col("_opens"), F.col("sys"))})
    return c.drop("_line", "_room", "_opens")


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: str | None = None) -> DataFrame:
    """(conv_id, span, first_window, n_system, n_history, n_new, tokens,
    over_budget, formatted, loss): ``loss`` lists (start, length) of the
    assistant texts under the loss mask, in code points of ``formatted``."""
    t = turns(conversations, budget, history, tokens)
    w = t.groupBy("conv_id", "span").agg(
        F.sort_array(F.collect_list(F.when(~F.col("retained"), F.col("item")))).alias("new"),
        F.min_by("hist", F.when(~F.col("retained"), F.col("pos"))).alias("hist"), F.max("sys").alias("sys"),
        (F.min("start") == 0).alias("first_window"))
    w = w.withColumn("sys", F.when(F.col("sys").isNull(), F.slice(F.array("sys"), 1, 0)).otherwise(F.array("sys")))
    w = w.withColumn("hist", F.coalesce("hist", F.slice("new", 1, 0)))
    w = w.withColumn("all", F.concat("sys", "hist", "new"))
    # a window has at most budget / MARK_TOKENS turns beside an over-long one, so the running sums stay short
    w = w.withColumn("at", F.aggregate(F.transform("all", lambda x: x["size"]), F.array(F.lit(0).cast("long")),
                                       lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n))))
    marked = F.transform("all", lambda x, i: F.when(
        x["target"].isNotNull() & (i >= F.size("sys") + F.size("hist")),
        F.struct((F.get("at", i) + x["target"]["at"]).alias("start"), x["target"]["length"].alias("length"))))
    total = F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    return w.select("conv_id", "span", "first_window", F.size("sys").cast("long").alias("n_system"),
                    F.size("hist").cast("long").alias("n_history"), F.size("new").cast("long").alias("n_new"),
                    total.alias("tokens"), (total > budget).alias("over_budget"),
                    F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"),
                    F.filter(marked, lambda x: x.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars) recovered from the output
    of ``windows`` alone: turns are parsed out of the formatted text, repeated
    ones dropped by the window's counts, the loss text cut out by the mask."""
    found = F.regexp_extract_all("formatted", F.lit(r"(?s)<\|im_start\|>(.*?)<\|im_end\|>\n"), F.lit(1))
    skip = F.when(F.col("first_window"), F.lit(0)).otherwise(F.col("n_system") + F.col("n_history")).cast("int")
    d = formatted.withColumn("_turns", found).withColumn("_skip", skip)
    d = d.withColumn("_own", F.slice("_turns", F.col("_skip") + 1, F.greatest(F.size("_turns") - F.col("_skip"), F.lit(0))))
    parsed = F.transform("_own", lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substring(x, F.char_length(F.substring_index(x, "\n", 1)) + 2, F.char_length(x))).alias("text")))
    target = F.transform("loss", lambda m: unescape(F.substring(
        F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    part = F.struct("span", parsed.alias("turns"), F.array_join(target, "").alias("target"),
                    F.char_length("formatted").cast("long").alias("n"))
    g = d.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("p"))
    return g.select("conv_id", F.flatten(F.transform("p", lambda x: x["turns"])).alias("turns"),
                    F.array_join(F.transform("p", lambda x: x["target"]), "").alias("loss_text"),
                    F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("formatted_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """The digest columns per conversation, computed from ``read_back``."""
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars")
