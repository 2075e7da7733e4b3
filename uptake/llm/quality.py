"""Quality by weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Each rule says good, bad or nothing about a text. Documents with the same votes are alike to the model, so the corpus
is reduced to counts of vote patterns (at most 3 ** rules rows, whatever the corpus), and EM estimates from these how
often each rule is right on good texts and, apart from that, on bad ones, and the share of good texts. A bad text has one
kind of defect, and only the rules that look for this kind see it: on the others it votes like a good text, so that their
good votes never outweigh the evidence. The posterior probability of good replaces all-must-pass filtering.

Defined results: a null or empty text has no words and fails the base rules; repeated rows count one by one; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import arrow_map, text_of
from uptake.session import materialize

WINDOW = 8
ROUNDS = 5000
#: accuracy of a rule before any vote, and how many votes that is worth: on good texts (the limits are set so that hardly
#: any crosses them) and on bad ones (little is known of which rules of a kind see a defect)
PRIOR = np.array([[0.998], [0.3]]), np.array([[100.0], [2.0]])
GOOD_PRIOR = (0.9, 20.0)

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_SYMBOLS = re.compile(r"[#*$%&|<>]")


def repeat_words(words: list, width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the list."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    mult = np.random.default_rng(3).integers(1, 1 << 62, width, dtype=np.uint64) | np.uint64(1)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        hashes += mixed[j:j + n] * mult[j]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    if not same.any():
        return 0
    views = np.lib.stride_tricks.sliding_window_view(ids, width)
    a, b = order[:-1][same], order[1:][same]
    if not (views[a] == views[b]).all():  # a collision of hashes: compare the windows themselves
        count: dict = {}
        for i in range(n):
            count.setdefault(tuple(words[i:i + width]), []).append(i)
        hit = np.array([i for v in count.values() if len(v) > 1 for i in v], dtype=np.int64)
    else:
        hit = np.unique(np.concatenate([a, b]))
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + width, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode().split()  # bytes: ASCII white space only
    spaces = sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    seen: set = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(" \t\x0b\x0c\r"):
            seen.add(line)
    return len(words), len(text) - spaces, len(_SYMBOLS.findall(text)), dup, repeat_words(words)


def _band(value, good, bad):
    """1 where ``good`` holds, -1 where ``bad`` holds, else 0 (the rule abstains)."""
    return F.when(value.isNull(), 0).when(good(value), 1).when(bad(value), -1).otherwise(0).cast("int")


#: rules by the kind of defect that they look for
KINDS = (("length",), ("word_length", "symbols", "letters"), ("dup_lines", "repeats", "variety"))


def rules() -> dict:
    """Votes by rule, from the measures and, for three of them, the text's length, lines and letters."""
    n = F.col("n_words").cast("double")
    per_word = lambda c: F.when(n > 0, F.col(c) / n)
    return {
        "length": _band(n, lambda v: v >= 50, lambda v: v < 20),
        "word_length": _band(per_word("word_chars"), lambda v: v.between(3, 9), lambda v: (v < 2.5) | (v > 12)),
        "symbols": _band(per_word("n_symbols"), lambda v: v < 0.05, lambda v: v > 0.2),
        # one or two lines said again are no evidence in a text of few lines
        "dup_lines": _band(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), lambda v: v < 0.1,
                           lambda v: (v > 0.3) & (F.col("n_dup_lines") > 2)),
        "repeats": _band(per_word("n_repeat_words"), lambda v: v < 0.1, lambda v: v > 0.25),
        "letters": _band(F.when(F.col("word_chars") > 0, F.col("n_letters") / F.col("word_chars")), lambda v: v > 0.8, lambda v: v < 0.5),
        "variety": _band(F.when(n >= 50, F.col("n_distinct") / F.pow(n, 0.7)), lambda v: v > 1.5, lambda v: v < 1),
    }


def fit_kinds(votes: np.ndarray, counts: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of good texts and of each kind of bad ones, and the rates of each rule, by EM over vote patterns.

    ``kinds`` (kind x rule) has 1 where the rule looks for that kind. Of the rates, row 0 is how often a vote on a text
    without the rule's kind is good, row 1 how often a vote on a text of its kind is bad. Abstaining tells nothing.
    """
    held, worth = PRIOR
    rates = np.repeat(held, votes.shape[1], axis=1)
    before = np.array([GOOD_PRIOR[0], *[(1 - GOOD_PRIOR[0]) / len(kinds)] * len(kinds)])
    shares = before
    for _ in range(ROUNDS):
        p = posterior(votes, shares, rates, kinds)
        bad = p[:, 1:] @ kinds  # pattern x rule: probability of the rule's kind
        right = np.stack([(counts[:, None] * (votes > 0) * (1 - bad)).sum(0), (counts[:, None] * (votes < 0) * bad).sum(0)])
        cast = np.stack([(counts[:, None] * (votes != 0) * (1 - bad)).sum(0), (counts[:, None] * (votes != 0) * bad).sum(0)])
        new = (right + held * worth) / (cast + worth)
        new[1] = np.maximum(new[1], 1 - new[0])  # a bad vote never speaks for a text
        new_shares = (counts @ p + before * GOOD_PRIOR[1]) / (counts.sum() + GOOD_PRIOR[1])
        done = max(np.abs(new_shares - shares).max(), np.abs(new - rates).max()) < 1e-9
        shares, rates = new_shares, new
        if done:
            break
    return shares, rates


def fit(votes: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
    """Share of good texts and rates of each rule on good and on bad texts, where all rules look for the same defect."""
    shares, rates = fit_kinds(votes, counts, np.ones((1, votes.shape[1])))
    return float(shares[0]), rates


def weights(rates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a good and a bad vote of each rule add to the log odds of its kind against good."""
    return np.log((1 - rates[1]) / rates[0]), np.log(rates[1] / (1 - rates[0]))


def posterior(votes: np.ndarray, shares: np.ndarray, rates: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Probabilities of good and of each kind of bad, by vote pattern."""
    good, bad = weights(rates)
    odds = np.exp(np.log(shares[1:] / shares[0]) + ((votes > 0) * good + (votes < 0) * bad) @ kinds.T)
    return np.column_stack([np.ones(len(votes)), odds]) / (1 + odds.sum(1, keepdims=True))


def judge(docs: DataFrame, keep_at: float = 0.5) -> DataFrame:
    """Measures, votes, posterior probability of good, and verdict of each document."""
    def run(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {c: [] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_distinct")}
        for t in cols["text"]:
            extra = (t.count("\n") + 1, len(re.findall(r"[^\W\d_]", t)), len(set(t.split())))
            for c, v in zip(out.values(), (*measure(t), *extra)):
                c.append(v)
        return {"doc_id": cols["doc_id"]} | out

    got = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")), run,
                    f"doc_id long, {FEATURES}, n_lines long, n_letters long, n_distinct long")
    voting = rules()
    got = materialize(got.withColumn("votes", F.array(*voting.values())), "votes")
    patterns = got.groupBy("votes").agg(F.count("*").alias("n")).collect()  # at most 3 ** rules rows
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kinds = np.array([[float(r in kind) for r in voting] for kind in KINDS])
    shares, rates = fit_kinds(np.array([r["votes"] for r in patterns]).reshape(-1, len(voting)),
                              np.array([r["n"] for r in patterns], dtype=float), kinds)

    def odds(k: int):
        terms = [F.when(F.col("votes")[i] > 0, float(g)).when(F.col("votes")[i] < 0, float(b)).otherwise(0.0)
                 for i, (g, b) in enumerate(zip(*weights(rates))) if kinds[k][i]]
        return F.exp(sum(terms, F.lit(float(np.log(shares[k + 1] / shares[0])))))

    p = 1 / sum((odds(k) for k in range(len(kinds))), F.lit(1.0))
    return got.withColumn("p_good", p).withColumn("base_failed", failed).withColumn("kept", ~failed & (p >= keep_at))
