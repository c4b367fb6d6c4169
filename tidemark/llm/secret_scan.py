"""Secret scan with DataFrame functions only, and corpus-wide ownership of what it finds.

Patterns give candidate spans.  Each candidate value is known by its hash; over
the whole corpus the scan counts in how many repositories and for how many
owners a value occurs.  Values copied widely are examples; the others look
live and belong to someone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import content_id, or_empty
from tidemark.session import cut_lineage

#: Base kinds in the order in which they are listed: pattern, group of the value, least length of the value (fixed values).
BASE = {
    "assign": (
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
    ),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: What the ownership count adds: long runs of mixed letters and digits that only few owners have.
ADDED, TOKEN = "owned", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}(?![A-Za-z0-9_-])"
KINDS = (*BASE, ADDED)
SPAN = "array<struct<start:int,end:int,rank:int,kind:string,value:string>>"


def matches(text: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """Spans (code points, end exclusive) of the leftmost non-overlapping matches whose value is long enough.

    The parts between the matches and the matches themselves have the text's
    length together, so a running sum gives the positions.
    """
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    walked = F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["whole"]), F.lit(0))).alias("at"),
            F.when(
                F.length(x["value"]) >= least,
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(x["gap"])).alias("start"),
                            (acc["at"] + F.length(x["gap"]) + F.length(x["whole"])).alias("end"),
                            F.lit(KINDS.index(kind)).alias("rank"),
                            F.lit(kind).alias("kind"),
                            x["value"].alias("value"),
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    # Most texts hold no match at all: one cheap search instead of three walks.
    return F.when(F.rlike(text, F.lit(pattern)), walked["spans"]).otherwise(F.array().cast(SPAN))


def candidates(text: Column) -> Column:
    """Base spans, and those of long mixed tokens outside of them."""
    base = F.concat(*[matches(text, *rule, kind) for kind, rule in BASE.items()])
    mixed = F.filter(
        matches(text, TOKEN, 0, 20, ADDED),
        lambda s: F.rlike(s["value"], F.lit("[0-9]")) & F.rlike(s["value"], F.lit("[A-Za-z]")),
    )
    outside = F.filter(mixed, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.concat(base, outside)


def ownership(found: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """(hash, n_repos, n_owners, live) of each value; a repository belongs to its owner.

    Repetitions collapse before every shuffle, and a value held by a third of
    the rows is spread by repository first, so no task counts it alone.
    """
    places = found.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    per_owner = places.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    counted = per_owner.groupBy("hash").agg(
        F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners")
    )
    widely = (F.col("n_owners") > max_owners) & (F.col("n_repos") > max_repos)
    return counted.withColumn("live", ~widely)


def scan_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    repo: str = "doc_id",
    owner: str = "source",
    max_owners: int = 2,
    max_repos: int = 4,
) -> DataFrame:
    """One row per document: the key, ``content`` and ``spans``.

    ``spans`` are structs (start, end, rank, kind, hash, n_repos, n_owners,
    live) by start, then kind.  Base kinds are always there, ``live`` telling
    an owner's credential from a widely copied example (more than
    ``max_owners`` owners and more than ``max_repos`` repositories); a span of
    kind ``owned`` is there only if it is live.

    NULL texts count as empty; a NULL owner or repository counts as one of its
    own; repeated rows give one row each and count once; other columns are
    ignored; an empty table gives an empty result.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        content_id(F.col(text)).alias("content"),
        F.col(repo).cast("string").alias("repo"),
        F.col(owner).cast("string").alias("owner"),
        candidates(or_empty(F.col(text))).alias("spans"),
    )
    # Read once: what follows needs the few spans, not the texts.
    rows = cut_lineage(
        rows.withColumn(
            "spans",
            F.transform(
                "spans",
                lambda s: F.struct(s["start"], s["end"], s["rank"], s["kind"], F.sha2(s["value"], 256).alias("hash")),
            ),
        )
    )
    found = rows.filter(F.size("spans") > 0).select("row", "owner", "repo", F.explode("spans").alias("span"))
    found = found.select("row", "owner", "repo", "span.*")
    verdicts = ownership(found, max_owners, max_repos)
    judged = found.join(verdicts, "hash").filter((F.col("kind") != ADDED) | F.col("live"))
    spans = judged.groupBy("row").agg(
        F.sort_array(
            F.collect_list(F.struct("start", "rank", "end", "kind", "hash", "n_repos", "n_owners", "live"))
        ).alias("spans")
    )
    return rows.drop("spans").join(spans, "row", "left").select(
        F.col("key").alias(key), "content", F.coalesce("spans", F.array()).alias("spans")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, scanned: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "<secret>") -> DataFrame:
    """``docs`` with every live span replaced by ``mark``; widely copied examples and clean texts stay."""
    live = scanned.select(
        F.col(key).alias("__key"), F.col("content").alias("__content"), F.filter("spans", lambda s: s["live"]).alias("__spans")
    )
    live = live.filter(F.size("__spans") > 0).dropDuplicates(["__key", "__content"])
    same = docs[key].eqNullSafe(live["__key"]) & (content_id(docs[text]) == live["__content"])
    walked = F.aggregate(
        F.col("__spans"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                # A span that starts within the one before it has been marked already.
                (s["start"] >= acc["at"]),
                F.concat(
                    acc["parts"],
                    F.array(F.substr(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)),
                ),
            ).otherwise(acc["parts"]).alias("parts"),
        ),
    )
    rest = F.substr(F.col(text), walked["at"] + 1)
    redacted = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(
        F.concat(F.array_join(walked["parts"], ""), rest)
    )
    joined = docs.join(live, same, "left").withColumn("__redacted", redacted)
    return joined.select(*[F.col("__redacted").alias(c) if c == text else docs[c] for c in docs.columns])
