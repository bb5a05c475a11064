"""Tables with every awkward row: nulls, empty and very long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside.
CLASHES = (
    "id", "content", "digest", "keep", "n", "src", "no", "size", "row", "words", "node", "part", "position", "score",
    "label", "copies", "kept_id", "kept_hash", "copy", "taken_id", "token", "k1", "shard", "start", "edge", "group",
)

WORDS = ("river", "stone", "Über", "cloud", "ñandú", "paper", "green", "walk", "seven", "lamp", "o", "ö", "train", "salt")


def prose(words: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(words))


def rows() -> list[tuple]:
    base = prose(120, 1)
    out = [
        (1, base, "en", "a", 1),
        (2, base.upper().replace("ÜBER", "Über").replace("ÑANDÚ", "ñandú").replace("Ö", "ö"), "en", "a", 1),
        (3, base + " end", "en", "b", 1),
        (4, base + " other end", None, None, None),
        (5, None, "de", "b", None),
        (6, "", "de", "b", 0),
        (7, " \n\t ", "de", "c", 4),
        (8, "one", "de", "c", 3),
        (9, "two words", None, "c", 9),
        (9, "two words", None, "c", 9),
        (None, "a row without an id", "en", "", 19),
        (None, base, "en", "", 19),
        (10, prose(180_000, 2), "en", "a", 1),
        (11, "x" * 1_500_000, "en", "a", 1),
        (12, prose(60, 3), "en", "c", 1),
        (13, prose(61, 4), "en", "c", 1),
    ]
    out += [(100 + k, prose(30 + k, 50 + k), "en", "ab"[k % 2], 1) for k in range(40)]
    out += [(200 + k, prose(80, 7) + f" v{k}", "en", "a", 1) for k in range(12)]
    return out


def documents(spark: SparkSession, given: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows() if given is None else given, DOCUMENTS).repartition(3)


def with_clashes(df: DataFrame) -> DataFrame:
    return df.select("*", *[F.lit("clash").alias(name) for name in CLASHES if name not in df.columns])


def ascii_lower(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))


def listed(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def check_table(operator, docs: DataFrame) -> list[tuple]:
    """Rows of an operator, which must not depend on extra columns; an empty table must give none of them."""
    have = listed(operator(docs))
    assert listed(operator(with_clashes(docs))) == have
    empty = operator(docs.limit(0))
    assert empty.columns == operator(docs).columns and empty.count() == 0
    return have
