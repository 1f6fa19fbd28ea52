"""Secret scans with corpus-wide ownership frequency.

Three base patterns (credential assignments, access keys, long hexadecimal runs) are found in
every whole text. Two further candidate patterns (prefixed tokens and long mixed-class tokens)
are found too; all candidates' SHA-256 hashes are counted over the distinct owners and the distinct
repositories that hold them. A candidate that EXAMPLE_OWNERS owners or more hold, in as many
repositories, is a copied example (mirrors of one repository don't make one); any other is a
credential, if it is of a base pattern or looks live (enough distinct characters, letters and
digits). Base spans are always reported, with their verdicts; further candidates only if they are
credentials and do not overlap a base span.

A text's matches are rows of their own from the first exchange on: running sums and extremes over
each row's matches give positions and overlaps, so time is linear in matches but for their sort.

Defined cases: a null text is empty; a null owner or repository counts as one owner or repository
of its own; repeated rows are reported each; an empty table gives no rows; other columns of the
input are not read (redact returns them as they came).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gondola.llm.common import materialise, text_or_empty

# Fixed patterns. Case classes are spelled out: engines differ in what a case-insensitive k or s matches.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]+)"
PREFIXED = r"((?:gh[pousr]_|sk_live_|xox[abp]-|eyJ)[A-Za-z0-9_.-]{16,})"
MIXED = r"([A-Za-z0-9+/_-]{24,})"
#: kind, pattern, group that holds the value, least length of the value, base; listed in the order of ties.
KINDS = [("assign", ASSIGN, 2, 8, True), ("access", ACCESS, 1, 16, True), ("hex", HEX, 1, 32, True), ("prefixed", PREFIXED, 1, 16, False), ("mixed", MIXED, 1, 24, False)]
#: A hash held by at least so many owners, in at least so many repositories, is a copied example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 3
#: Values of the further patterns with fewer distinct characters than this don't look live.
LIVE_CHARS = 10
#: A table of documents with hidden values up to this many rows (about 150 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_HIDDEN = 200_000
_BASE = sum(k[4] for k in KINDS)


def _found(text: Column, rank: int, pattern: str, group: int, whole: bool) -> Column:
    """Array of (rank, gap, match, value) of one kind's matches; gap: the characters since the match before, match: its own."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) if whole else values
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))
    found = F.transform(
        F.filter(pairs, lambda x: x["match"].isNotNull()),  # a last gap has no match
        lambda x: F.struct(F.lit(rank).alias("rank"), F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("match"), x["value"].alias("value")),
    )
    # most texts hold none: a plain test first. Runs of a single class can be tested with their least length.
    least = KINDS[rank][3]
    test = {"hex": f"[0-9a-f]{{{least}}}", "access": f"AKIA[A-Z0-9]{{{least - 4}}}"}.get(KINDS[rank][0], pattern)
    return F.when(text.rlike(test), found).otherwise(F.array().cast("array<struct<rank:int,gap:int,match:int,value:string>>"))


def _looks_live(v: Column) -> Column:
    return (F.size(F.array_distinct(F.split(v, ""))) >= LIVE_CHARS) & v.rlike("[0-9]") & v.rlike("[A-Za-z]")


def matches(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """_row, _key (a hash of the text), doc_id, owner, repository of every row and found: its matches as (rank, gap, match, hash, long, live)."""
    text = F.col("_text")
    step = docs.select("doc_id", F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"), text_or_empty().alias("_text"))
    arrays = []
    for rank, (kind, pattern, group, least, _) in enumerate(KINDS):
        # runs: of a class of characters, so only those of the least length matter, whatever lies between
        pattern = f"([0-9a-f]{{{least},}})" if kind == "hex" else f"(AKIA[A-Z0-9]{{{least - 4},}})" if kind == "access" else pattern
        arrays.append(_found(text, rank, pattern, group, kind == "assign"))
    least = F.array(*[F.lit(k[3]) for k in KINDS])
    shaped = lambda x: F.struct(
        x["rank"],
        x["gap"],
        x["match"],
        F.sha2(x["value"], 256).alias("hash"),
        (F.length(x["value"]) >= F.element_at(least, x["rank"] + 1)).alias("long"),
        ((x["rank"] < _BASE) | _looks_live(x["value"])).alias("live"),
    )
    return step.select(F.monotonically_increasing_id().alias("_row"), F.xxhash64("_text").alias("_key"), "doc_id", "owner", "repository", F.transform(F.concat(*arrays), shaped).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, owners, repositories: how many distinct ones hold each candidate (partial distincts before each exchange)."""
    held = found.where(F.size("found") > 0).select("owner", "repository", F.explode(F.filter("found", lambda x: x["long"])).alias("x")).select("owner", "repository", "x.hash").distinct()
    by_owner = held.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    by_repository = held.select("hash", "repository").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("repositories"))
    return by_owner.join(by_repository, "hash")


def _is_example() -> Column:
    return (F.col("owners") >= EXAMPLE_OWNERS) & (F.col("repositories") >= EXAMPLE_REPOSITORIES)


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """_row, doc_id and spans of every row: array of (start, end, kind, base, verdict, owners, repositories) by start, then kind as listed.

    verdict: example, or credential. Positions are in code points, end exclusive.
    """
    found = materialise(matches(docs, owner, repository), "secret-matches")
    every = found.where(F.size("found") > 0).select("_row", F.posexplode("found").alias("_at", "x")).select("_row", "_at", "x.*")
    before = Window.partitionBy("_row", "rank").orderBy("_at")
    end = F.sum(F.col("gap") + F.col("match")).over(before.rowsBetween(Window.unboundedPreceding, 0))
    placed = every.withColumn("end", end.cast("int")).withColumn("start", F.col("end") - F.col("match")).where("long")
    judged = placed.join(ownership(found), "hash")
    verdict = F.when(_is_example(), F.lit("example")).when(F.col("live"), F.lit("credential")).otherwise(F.lit("unsure"))
    judged = judged.withColumns({"base": F.col("rank") < _BASE, "verdict": verdict})
    # the end of the base spans that start at or before a candidate, and the start of those after it
    ahead = Window.partitionBy("_row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("_row").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, 0)
    base = lambda c: F.when(F.col("base"), F.col(c))
    around = judged.withColumns({"_ended": F.max(base("end")).over(ahead), "_starts": F.min(base("start")).over(behind)})
    clear = (F.coalesce("_ended", F.lit(0)) <= F.col("start")) & (F.col("_starts").isNull() | (F.col("_starts") >= F.col("end")))
    kept = around.where(F.col("base") | ((F.col("verdict") == "credential") & clear))
    kind = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("rank") + 1)
    spans = kept.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", kind.alias("kind"), "base", "verdict", "owners", "repositories"))).alias("spans"))
    shaped = F.transform("spans", lambda x: F.struct(*[x[c] for c in ("start", "end", "kind", "base", "verdict", "owners", "repositories")]))
    return found.select("_row", "doc_id").join(spans.select("_row", shaped.alias("spans")), "_row", "left")


def redact(docs: DataFrame, mark: str = "[SECRET]", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """docs with every value that is no copied example (of further patterns: and looks live) replaced by a mark.

    A value goes wherever it stands in the document, longer values first. Owners are counted over the whole table first; then each document's own values are looked up
    by its text's hash (texts that share one mask what each holds). n_chars follows the text if present. Widely copied examples stay as they are.
    """
    found = materialise(matches(docs, owner, repository), "redact-matches")
    few = ownership(found).where(~_is_example())
    spans = found.where(F.size("found") > 0).select(F.col("_key").alias("_of"), F.inline("found")).where("live and long")
    hidden = materialise(spans.join(few, "hash").groupBy("_of").agg(F.collect_set("hash").alias("_hashes")), "redact-hidden")
    if hidden.count() <= BROADCAST_HIDDEN:
        hidden = F.broadcast(hidden)
    whole = docs.select(F.xxhash64(text_or_empty()).alias("_key"), F.struct(*docs.columns).alias("_doc"))
    held = whole.join(hidden, F.col("_key") == F.col("_of"), "left")
    text, values = F.col("_doc.text"), []
    for _, pattern, group, least, _ in KINDS:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))
        values.append(F.filter(found, lambda v, k=least: (F.length(v) >= k) & F.array_contains(F.col("_hashes"), F.sha2(v, 256))))
    # longer ones first: a value may hold another
    ordered = F.array_sort(F.transform(F.array_union(F.concat(*values), F.array().cast("array<string>")), lambda v: F.struct((-F.length(v)).alias("n"), v.alias("v"))))
    cut = F.aggregate(ordered, text, lambda acc, x: F.replace(acc, x["v"], F.lit(mark)))
    hide = F.col("_hashes").isNotNull()
    out = {"text": F.when(hide, cut).otherwise(text)}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(hide, F.length(out["text"]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("_doc.n_chars"))
    return held.select(*[out.get(c, F.col("_doc")[c]).alias(c) for c in docs.columns])
