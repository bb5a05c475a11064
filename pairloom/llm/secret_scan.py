"""Secret scans: patterns, and multipart credentials linked by an interval join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.text import whole

# The base patterns. The value of an assignment is its second group.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

# Weak parts, which alone say little.
WEAK_ID = r"(?:ASIA|AROA|AIDA|AGPA)[A-Z0-9]{16,}|(?i)\b(?:client_?id|username|login)\x20*[:=]\x20*[^\s,;]+"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+"
ENDPOINT = r"""https?://[^\s"'<>]+"""
BREAK = r"\n[\x20\t\r]*\n"

# The kinds in the order that settles equal starts: name, pattern, what it is a part of, base or weak.
_KINDS = (
    ("assign", ASSIGN, "secret", True),
    ("access", ACCESS, "id", True),
    ("hex", HEX, "secret", True),
    ("weak-id", WEAK_ID, "id", False),
    ("weak-secret", WEAK_SECRET, "secret", False),
    ("endpoint", ENDPOINT, "endpoint", False),
    ("break", BREAK, "break", False),
)


def _found(name: str, pattern: str) -> Column:
    """``[(gap, size, good)]`` of the leftmost matches: characters since the match before, length, and whether it counts."""
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    if name == "assign":
        values = F.regexp_extract_all("text", F.lit(pattern), F.lit(2))
        good = F.transform(values, lambda value: F.length(value) >= ASSIGN_LEAST)
    elif name == "weak-secret":
        good = F.transform(matches, lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]"))
    else:
        good = F.transform(matches, lambda m: F.lit(True))
    gaps = F.transform(F.split("text", pattern, -1), F.length)
    sizes = F.transform(matches, F.length)
    zipped = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), good.alias("good"))
    # The text after the last match has no size.
    return F.filter(zipped, lambda part: part["size"].isNotNull())


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """``(id_col, n_assign, n_access, n_hex, n_linked, base_sha256, spans)``, a row for every row of ``docs``.

    Base matches always count. Access identifiers, secrets and endpoints that are weak by
    themselves are reported only when a complementary part lies in the same scope, a run of text
    without an empty line, and within ``reach`` characters: a weak identifier or an endpoint beside
    a secret of either strength, a weak secret beside an identifier or an endpoint. Linked parts do not
    overlap, so a part of a long url is no secret beside it. The interval join is a sweep over the
    starts and ends of the parts of a scope, which knows the end of the last complementary part
    before and the start of the next one; no pair of parts is made.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind.
    ``base_sha256`` is the digest of the base spans joined by commas, ``spans`` has all. A null or
    empty text has none; without spans the digest is that of the empty string. Rows that repeat an
    id stay apart by a row number; other columns are not read. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("id"), whole(F.col(text_col)).alias("text"))
    nothing = F.array().cast("array<struct<gap:int,size:int,good:boolean>>")
    strong = {name: F.col("text").rlike(pattern) for name, pattern, _, _ in _KINDS if name not in ("break", "endpoint")}
    flags = texts.select("id", "text", *[flag.alias(f"has_{name}") for name, flag in strong.items()])
    any_part = F.lit(False)
    for name in strong:
        any_part = any_part | F.col(f"has_{name}")
    kinds = []
    for order, (name, pattern, _, _) in enumerate(_KINDS):
        there = F.col(f"has_{name}") if name in strong else any_part
        kinds.append(F.struct(F.lit(order).alias("kind"), F.when(there, _found(name, pattern)).otherwise(nothing).alias("found")))
    # Rows are numbered before they are taken apart. A text without matches keeps one row, of the first kind.
    numbered = flags.select(F.monotonically_increasing_id().alias("row"), "id", F.array(*kinds).alias("parts"))
    per_kind = numbered.select("row", "id", F.explode("parts").alias("part"))
    per_kind = per_kind.filter((F.col("part.kind") == 0) | (F.size("part.found") > 0))
    matches = per_kind.select("row", "id", F.col("part.kind").alias("kind"), F.posexplode_outer("part.found").alias("at", "match"))

    in_kind = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("match.gap") + F.col("match.size")).over(in_kind)
    placed = matches.select("row", "id", "kind", F.col("match.good").alias("good"), (end - F.col("match.size")).alias("start"), end.alias("end"))

    def one_of(part: str) -> Column:
        orders = [order for order, (_, _, of, _) in enumerate(_KINDS) if of == part]
        return F.coalesce(F.col("good"), F.lit(False)) & F.col("kind").isin(orders)

    by_start = Window.partitionBy("row").orderBy("start", "kind")
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scoped = placed.withColumn("scope", F.sum(one_of("break").cast("int")).over(so_far))
    # Each part stands twice, at its start and at its end, ends first: then what ends before a start precedes it, what
    # starts after an end follows it, and no part finds itself or one that it overlaps.
    sides = F.explode(F.array(*[F.struct(F.col(side).alias("at"), F.lit(k).alias("is_start")) for k, side in enumerate(("end", "start"))]))
    sides = scoped.select("*", sides.alias("side")).select("*", "side.at", "side.is_start").drop("side")
    in_scope = Window.partitionBy("row", "scope").orderBy("at", "is_start")
    before = in_scope.rowsBetween(Window.unboundedPreceding, -1)
    after = in_scope.rowsBetween(1, Window.unboundedFollowing)

    def near(*parts: str) -> Column:
        there = one_of(parts[0])
        for part in parts[1:]:
            there = there | one_of(part)
        last = F.max(F.when(there & (F.col("is_start") == 0), F.col("at"))).over(before)
        following = F.min(F.when(there & (F.col("is_start") == 1), F.col("at"))).over(after)
        return F.when(F.col("is_start") == 1, F.col("at") - last <= reach).otherwise(following - F.col("at") <= reach)

    linked = sides.withColumn("by_secret", near("secret")).withColumn("by_other", near("id", "endpoint"))
    # Both sides of a part lie in one scope, so this needs no shuffle.
    part = ["row", "scope", "id", "kind", "start", "end", "good"]
    linked = linked.groupBy(*part).agg(*[F.max(F.coalesce(name, F.lit(False))).alias(name) for name in ("by_secret", "by_other")])
    weak = [order for order, (_, _, part, base) in enumerate(_KINDS) if not base and part != "break"]
    weak_secrets = [order for order in weak if _KINDS[order][2] == "secret"]
    is_base = F.coalesce(F.col("good"), F.lit(False)) & F.col("kind").isin([o for o, k in enumerate(_KINDS) if k[3]])
    joined = F.when(F.col("kind").isin(weak_secrets), F.col("by_other")).otherwise(F.col("by_secret"))
    is_linked = F.coalesce(F.col("good") & F.col("kind").isin(weak) & joined, F.lit(False))
    names = F.array(*[F.lit(name) for name, _, _, _ in _KINDS])
    label = F.concat_ws(":", F.element_at(names, F.col("kind") + 1), F.col("start"), F.col("end"))
    span = F.struct("start", "kind", label.alias("label"))

    def spans(which: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.when(which, span)))
        return F.array_join(F.transform(listed, lambda one: one["label"]), ",")

    def count(order: int) -> Column:
        return F.sum((F.coalesce(F.col("good"), F.lit(False)) & (F.col("kind") == order)).cast("long"))

    # One group per row of the table: no larger than that row's text.
    grouped = linked.withColumns({"is_base": is_base, "is_linked": is_linked}).groupBy("row", "id")
    result = grouped.agg(
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sum(F.col("is_linked").cast("long")).alias("n_linked"),
        F.sha2(spans(F.col("is_base")), 256).alias("base_sha256"),
        spans(F.col("is_base") | F.col("is_linked")).alias("spans"),
    )
    return result.select(F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "n_linked", "base_sha256", "spans")
