"""Secret scan with corpus-wide ownership frequency.

Every text is scanned for assignments to secret-like names, cloud access keys and long hexadecimal runs (the base
kinds), and for random-looking tokens. Values of all of them are hashed, and for each hash the distinct repositories
and owners that hold it are counted over the corpus: one that many owners hold is a widely copied example, one of few
owners looks live, in however many of their repositories and copies it lies. Random-looking tokens that look live are
reported as kind ``owned``, beside all base spans. Redaction replaces all reported spans, so base spans always go.

Counts go through distinct (hash, owner) and (hash, repository) rows, combined before each shuffle, so a value found in
a third of all documents never lies in one task; the verdict joins back under skew splitting.

Defined results: a null text is empty; a null owner or repository counts as one of its own; repeated rows are scanned
one by one and count once as a repository; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import arrow_map, text_of
from uptake.session import materialize

# Kinds, patterns and least lengths of the contract
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "owned")
LEAST = {"assign": 12, "access": 18, "hex": 16}

TOKEN = r"[A-Za-z0-9+/_-]{24,}"  #: what may be a random-looking token
MIN_ENTROPY = 3.7  #: bits a character that such a token has at least
MAX_OWNERS = 1  #: owners that a live-looking value has at most


def _random_looking(t: str) -> bool:
    if not (any("0" <= c <= "9" for c in t) and any("a" <= c <= "z" for c in t) and any("A" <= c <= "Z" for c in t)):
        return False
    n = len(t)
    return -sum(c / n * math.log2(c / n) for c in Counter(t).values()) >= MIN_ENTROPY


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """``(start, kind number, end, value)`` of the base spans and of random-looking tokens outside them, sorted."""
    found = [(m.start(), 0, m.end(), m[2]) for m in re.finditer(ASSIGN, text, re.A | re.I) if len(m[2]) >= LEAST["assign"]]
    found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(ACCESS, text) if len(m[0]) >= LEAST["access"]]
    # a greedy run of at least 16 is the same as a run that is dropped when shorter
    found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(HEX[:-1] + "{%d,}" % LEAST["hex"], text)]
    found.sort()
    base, extra, at, upto = found, [], 0, 0
    for m in re.finditer(TOKEN, text):
        while at < len(base) and base[at][0] < m.end():
            upto = max(upto, base[at][2])
            at += 1
        if upto <= m.start() and _random_looking(m[0]):
            extra.append((m.start(), 3, m.end(), m[0]))
    return sorted(base + extra)


def find_secrets(docs: DataFrame, repo: str = "doc_id", owner: str = "source", max_owners: int = MAX_OWNERS,
                 keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``row`` (its number in this run), the columns ``keep`` and ``found``, an array by start.

    Elements of ``found``: start, kind, end, owners, repos, live. Tokens that do not look live are left out.
    """
    keep = keep or ["doc_id"]

    def run(cols: dict[str, list]) -> dict[str, list]:
        spans = [scan(t) for t in cols["_text"]]
        return {c: v for c, v in cols.items() if c != "_text"} | {"spans": [
            [{"start": s, "kind": KINDS[k], "end": e, "value": hashlib.sha256(v.encode()).hexdigest()[:32]} for s, k, e, v in x]
            for x in spans]}

    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(repo).cast("string").alias("repo"),
                      F.col(owner).cast("string").alias("owner"), *[F.col(c).alias(f"k_{c}") for c in keep], text_of("text").alias("_text"))
    kinds = dict(src.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in src.columns if c != "_text")
    scanned = materialize(arrow_map(src, run, schema + ", spans array<struct<start: bigint, kind: string, end: bigint, value: string>>"), "scanned")
    each = scanned.select("row", "repo", "owner", F.explode("spans").alias("s")).select("row", "repo", "owner", "s.*")
    by = lambda c: (each.select("value", c).distinct().groupBy("value")
                    .agg((F.count(c) + F.max(F.col(c).isNull().cast("long"))).alias(f"{c}s")))
    held = by("owner").join(by("repo"), "value")
    verdict = (each.join(held, "value").withColumn("live", F.col("owners") <= max_owners)
               .where("live or kind <> 'owned'"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    spans = verdict.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "start", rank.alias("rank"), "end", "kind", "owners", "repos", "live"))).alias("found"))
    cols = [F.col(f"k_{c}").alias(c) for c in keep]
    empty = F.array().cast(spans.schema["found"].dataType)
    return scanned.drop("spans").join(spans, "row", "left").select("row", *cols, F.coalesce("found", empty).alias("found"))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of each document."""
    base = F.filter("found", lambda s: s["kind"] != "owned")

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    examples = F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_examples")
    return find_secrets(docs).select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                                     _joined(F.col("found")).alias("spans"), examples)


def redact(docs: DataFrame, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with every reported span replaced by ``mark`` and ``n_chars`` brought up to date."""
    cols = docs.columns
    safe = [f"c{i}" for i in range(len(cols))]  # no name of the input's meets one of the scan's
    text, n_chars = safe[cols.index("text")], safe[cols.index("n_chars")] if "n_chars" in cols else None
    named = docs.select(*[F.col(f"`{c}`").alias(s) for c, s in zip(cols, safe)], "doc_id", "source", "text")
    held = find_secrets(named, keep=safe)

    def run(blocks: dict[str, list]) -> dict[str, list]:
        out = []
        for t, spans in zip(blocks[text], blocks["found"]):
            parts, at = [], 0
            for s in spans:
                if s["end"] <= at:
                    continue
                if s["start"] >= at:
                    parts += [t[at:s["start"]], mark]
                at = s["end"]
            out.append(t if t is None or not spans else "".join(parts) + t[at:])
        # a null text stays as it is, and so does its count
        n = {n_chars: [old if t is None else len(t) for t, old in zip(out, blocks[n_chars])]} if n_chars else {}
        return {c: blocks[c] for c in safe} | {text: out} | n

    kinds = dict(named.dtypes)
    return arrow_map(held.drop("row"), run, ", ".join(f"`{c}` {kinds[c]}" for c in safe)).toDF(*cols)
