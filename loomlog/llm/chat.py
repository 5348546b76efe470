"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of one role merge into
one block, and the blocks are concatenated:

    <|turn|>role<|body|>text<|also|>text of the next turn of that role<|end|>

Texts of assistant turns are under the loss mask. Control strings inside a text or a role - those
of this template and those of other common ones, `<s>`, `</s>`, `[INST]`, `[/INST]` - get one
backslash after their first character, or one more where backslashes stand there already, so that
no text can hold a control string and read_back() restores it exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, ALSO, END = "<|turn|>", "<|body|>", "<|also|>", "<|end|>"
_TAIL = r"(\||/?s>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAIL, "$1$2$3")


def format_chats(
    turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", trained: str = "assistant",
) -> DataFrame:
    """One row for each conversation: id_col, formatted, loss_spans (array of start and length in
    code points of formatted, from 0: the texts of the `trained` role).

    Turns are in order of turn, then role, then text (a null turn comes first); repeated rows are
    turns of their own. A null text or role is empty. Rows with a null id make one conversation. An
    empty table gives no rows; other columns are ignored, whatever their names. A conversation is one
    row, so its turns meet in one task: the method collects them, and its output is one text. Time
    grows with the turns times their square root, and with the texts' length."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(id_col).alias("id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text")).alias("x"))
    chats = rows.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("x")).withColumn("n", F.size("x"))

    def heads(x: Column, n: Column) -> Column:
        first = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at(x, i)["role"] != F.element_at(x, F.greatest(i - 1, F.lit(1)))["role"]))
        return F.concat(first, F.array(n + 1))

    def block(x: Column, at: Column) -> Column:
        def one(i: Column, k: Column) -> Column:
            return F.struct(F.element_at(x, i)["role"].alias("role"), F.transform(F.slice(x, i, F.element_at(at, k + 2) - i), lambda t: escape(t["text"])).alias("texts"))

        return F.transform(F.slice(at, 1, F.size(at) - 1), one)

    chats = chats.withColumn("at", heads(F.col("x"), F.col("n"))).select("id", block(F.col("x"), F.col("at")).alias("blocks"))

    def pieces(b: Column) -> Column:
        opening = F.concat(F.lit(TURN), escape(b["role"]), F.lit(BODY))
        texts = F.transform(b["texts"], lambda t, i: F.struct(F.when(i == 0, opening).otherwise(F.lit(ALSO)).alias("mark"), t.alias("text"), (b["role"] == trained).alias("loss")))
        return F.concat(texts, F.array(F.struct(F.lit(END).alias("mark"), F.lit("").alias("text"), F.lit(False).alias("loss"))))

    chats = chats.select("id", F.flatten(F.transform("blocks", pieces)).alias("pieces"))
    sizes = F.transform("pieces", lambda p: (F.length(p["mark"]) + F.length(p["text"])).cast("long"))
    chats = with_starts(chats.withColumn("sizes", sizes), "sizes", "starts")
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["text"])), "")
    each = F.zip_with("pieces", "starts", lambda p, at: F.struct((at + F.length(p["mark"])).alias("start"), F.length(p["text"]).cast("long").alias("length"), p["loss"].alias("loss")))
    chats = chats.select("id", formatted.alias("formatted"), F.filter(each, lambda s: s["loss"]).alias("loss_spans"))
    spans = F.transform("loss_spans", lambda s: F.struct(s["start"], s["length"]))
    return chats.select(F.col("id").alias(id_col), "formatted", spans.cast("array<struct<start:bigint,length:bigint>>").alias("loss_spans"))


def with_starts(df: DataFrame, sizes: str, out: str) -> DataFrame:
    """Adds where each of an array of sizes begins if they stand one behind the other. Sums run within
    chunks of about the root of the array's length and over the chunks, as appending to an array
    copies it."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def grow(acc: Column, n: Column) -> Column:
        return F.struct((acc["at"] + n).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out"))

    df = df.withColumn("_n", F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(sizes)))).cast("int"))
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(sizes) - 1) / F.col("_n")).cast("int"))), lambda k: F.slice(sizes, k * F.col("_n") + 1, F.col("_n")))
    df = df.withColumn("_chunks", chunks)
    df = df.withColumn("_sums", F.transform("_chunks", lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, n: a + n)))
    df = df.withColumn("_at", F.aggregate("_sums", empty, grow, lambda acc: acc["out"]))
    own = F.zip_with("_chunks", "_at", lambda c, at: F.transform(F.aggregate(c, empty, grow, lambda acc: acc["out"]), lambda k: k + at))
    return df.withColumn(out, F.flatten(own)).drop("_n", "_chunks", "_sums", "_at")


def read_back(formatted: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """(id_col, turns array<struct<role, text>>, loss array<string>, formatted_chars) of format_chats' rows, taken
    from the formatted string and the mask alone. The string is cut before each control string; what
    stands under the mask is each cut whose text begins where a span does, to the span's length."""

    def of_block(b: Column) -> Column:
        cut = F.instr(b, BODY)
        role = unescape(F.substring(b, F.lit(1), cut - 1))
        texts = F.split(F.substring(b, cut + len(BODY), F.length(b)), r"<\|also\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    blocks = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda b: b != "")
    blocks = F.transform(blocks, lambda b: F.substring(b, F.lit(1), F.length(b) - len(END)))
    x = formatted.select(id_col, "formatted", "loss_spans", F.flatten(F.transform(blocks, of_block)).alias("turns"))
    x = x.withColumn("cuts", F.split("formatted", r"(?=<\|(?:turn|body|also|end)\|>)", -1))
    x = with_starts(x.withColumn("sizes", F.transform("cuts", lambda c: F.length(c).cast("long"))), "sizes", "starts")
    # spans by chunks of the string's length, so that a cut meets few of them
    x = x.withColumn("_w", F.greatest(F.lit(1), F.ceil(F.length("formatted") / F.sqrt(F.size("cuts")))).cast("long"))
    x = x.withColumn("_of", F.transform(F.sequence(F.lit(0), F.floor(F.length("formatted") / F.col("_w")).cast("int")), lambda k: F.filter("loss_spans", lambda s: F.floor(s["start"] / F.col("_w")) == k)))

    def under(cut: Column, at: Column) -> Column:
        begin = at + len(BODY)  # as long as ALSO
        near = F.filter(F.get(F.col("_of"), F.floor(begin / F.col("_w")).cast("int")), lambda s: s["start"] == begin)
        return F.when(F.size(near) > 0, unescape(F.substring(cut, F.lit(len(BODY) + 1), F.get(near, F.lit(0))["length"].cast("int"))))

    loss = F.array_compact(F.zip_with("cuts", "starts", under))
    return x.select(id_col, "turns", loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))


def digests(turns: DataFrame, *, id_col: str = "conv_id") -> DataFrame:
    """Counts and digests of the formatted conversations, as read back from the output."""
    back = read_back(format_chats(turns, id_col=id_col), id_col=id_col)
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        id_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


#: DuckDB SQL of digests() over conversations and the conversation -1.
SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS NOT DISTINCT FROM role AS merged,
    length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:\||/?s>|/?INST\])')) AS n, length(role) + len(regexp_extract_all(role, '[<\[]\\*(?:\||/?s>|/?INST\])')) AS m
  FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE WHEN merged THEN 8 ELSE 8 + m + 8 + 7 END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
