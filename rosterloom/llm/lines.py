"""Lines that many documents share: found by hash, dropped from all documents but one, texts put together again.

Only DataFrame functions. A line travels as two 64-bit hashes of its key and its place, so a join never moves line texts;
counts are combined in the tasks first. What comes back to a row are the places of the lines it loses.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterloom.llm.storage import stored, unused

_SPACES = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_SPACES)), ascii_uppercase, ascii_lowercase)


def _code(key: Column) -> Column:
    """128 bits that stand for a key."""
    return F.struct(F.xxhash64(key).alias("x"), F.xxhash64(F.lit(1), key).alias("y"))


def with_kept_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """`docs` with a struct column `lines`: n_lines, n_dropped and text, the text that remains.

    Lines end at line feeds; null and empty texts are one empty line. A key of at least `min_chars` code points that
    occurs in at least `min_docs` documents loses all its lines except in the largest doc_id that holds it; if that
    document repeats the line, all its copies stay. Rows that repeat a doc_id count as one document, and those that share
    the largest one all keep the line. Rows without a doc_id count as a document each, and lose their shared lines unless
    no row with the line has a doc_id. Columns of `docs` stay, whatever their names; `lines` gets underscores if
    the name is taken. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A row goes by its id and a code of its text: what is gathered for it below is never more than its own lines.
    key = {"doc": F.col("doc_id"), "t": F.xxhash64(text), "u": F.xxhash64(F.lit(1), text)}
    split = F.split(text, "\n", -1)
    keyed = F.transform(split, lambda line, at: F.struct(line_key(line).alias("key"), at.alias("at")))
    long_ = F.filter(keyed, lambda line: F.char_length(line["key"]) >= min_chars)
    coded = F.transform(long_, lambda line: F.struct(_code(line["key"]).alias("code"), line["at"].alias("at")))
    sorted_ = docs.select(*[c.alias(k) for k, c in key.items()], F.array_sort(coded).alias("lines"))
    # In the order of codes, the first place of each line of a row is known by its neighbour.
    first = F.transform(
        "lines",
        lambda line, k: F.struct(
            line["code"].alias("code"),
            line["at"].alias("at"),
            ((k == 0) | (F.get("lines", k - 1)["code"] != line["code"])).alias("first"),
        ),
    )
    held = stored(
        sorted_.select(*key, F.explode(first).alias("line")).select(*key, "line.code.*", "line.at", "line.first"), "lines"
    )
    # Written first: both sides of the join below are then plain shuffles, whose hot partitions Spark can split.
    counted = held.groupBy("x", "y").agg(
        (F.count_distinct("doc") + F.count_if(F.col("doc").isNull() & F.col("first"))).alias("n"), F.max("doc").alias("keeper")
    )
    shared = stored(counted.where(F.col("n") >= min_docs).select("x", "y", "keeper"), "shared-lines")
    losses = (
        held.join(shared, ["x", "y"])
        .where(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy(*key)
        .agg(F.collect_set("at").alias("gone"))
    )
    same = [c.eqNullSafe(losses[k]) if k == "doc" else c == losses[k] for k, c in key.items()]
    parts = unused(docs, "line_parts")
    joined = docs.join(losses, reduce(lambda a, b: a & b, same), "left").select(
        *[docs[c] for c in docs.columns], F.struct(split.alias("lines"), losses["gone"].alias("gone")).alias(parts)
    )
    of = lambda name: F.col(f"{parts}.{name}")
    every = F.sequence(F.lit(0), F.size(of("lines")) - 1)
    kept = F.when(of("gone").isNull(), of("lines")).otherwise(
        F.transform(F.array_except(every, of("gone")), lambda at: F.get(of("lines"), at))
    )
    return joined.select(
        *docs.columns,
        F.struct(
            F.size(of("lines")).cast("long").alias("n_lines"),
            F.coalesce(F.size(of("gone")), F.lit(0)).cast("long").alias("n_dropped"),
            F.array_join(kept, "\n").alias("text"),
        ).alias(unused(docs, "lines")),
    )


def line_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (lower-case hex over UTF-8) of every row; see `with_kept_lines`."""
    found = with_kept_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256"))
