"""Mix sources to target weights by entropy balancing (DataFrame functions only).

Every document may be taken up to ``CAP`` times. Its rate is the entropy-nearest to an even rate, under its source's
token constraint: ``CAP * sigmoid(lambda * size / mean size)``, where lambda is the source's dual variable. The convex
dual is solved by safeguarded Newton steps, each one distributed aggregation over the histogram of (source, size),
which carries all the tilt depends on. Rates become whole copies by rounding running sums over sizes; what the rounding
leaves of the target is added to or taken from the first sizes that can bear it, so one document per source may be
taken in part and the source meets its target within a word.

Targets: sources by code point (null last) weigh 3, 1, 2 in turn and share ``budget`` times all words; a target stops
at ``CAP`` times its source's size and the excess is shared anew by weight.

Copies of a size go to its documents in hash order, by counts per hash slice, so no task holds a whole size.

Defined results: a null or empty text has size 0 and is taken 0 times; repeated rows are mixed one by one; a source
without words has target 0; an empty table gives no rows. A row's own columns travel as one struct: extra columns of any
name are kept, but for those that ``mix`` itself adds. Newton steps that do not converge end the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import WORD, pow2_at_least
from uptake.session import materialize

CAP = 2
BUDGET = 1.5
WEIGHTS = (3, 1, 2)
SLICE = 8192
ROUNDS, STEPS = 40, 3  #: Newton steps at most: rounds of jobs, and steps planned in each
TOLERANCE = 1e-4


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``sources`` (``src``, ``source_size``; one row a source) with ``target``."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]),
                     ((F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1) % len(WEIGHTS) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("top", F.lit(float(CAP)) * F.col("source_size"))
    order = Window.orderBy(F.col("top") / F.col("w"), F.col("src").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    s = (s.withColumn("total", F.sum("source_size").over(Window.partitionBy(F.lit(0))))
         # the level that this source and those above it share if all below are full
         .withColumn("level", (F.col("total") * budget - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("w").over(after))
         .withColumn("level", F.min(F.when(F.col("top") / F.col("w") > F.col("level"), F.struct(F.col("top") / F.col("w"), "level")))
                     .over(Window.partitionBy(F.lit(0)))["level"]))
    return s.select("src", "source_size", F.least("top", F.coalesce(F.col("w") * F.col("level"), F.col("top"))).alias("target"))


def _rate(lam: Column) -> Column:
    z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), lam * F.col("z")))
    return F.when(F.col("full"), F.lit(float(CAP))).otherwise(CAP / (1 + F.exp(-z)))


def solve(hist: DataFrame, goals: DataFrame) -> DataFrame:
    """``(src, lam, full)``: the dual variable of each source; ``full`` where its target is all it can give."""
    kind = goals.select("src", "target", (F.col("source_size") > 0).alias("any"),
                        (F.col("target") >= CAP * F.col("source_size")).alias("full"), F.lit(0.0).alias("lam"))
    # a source without words, or one that gives all it can, has nothing to solve
    settled = kind.where("full or not any").select("src", "lam", "full")
    none = F.lit(None).cast("double")
    duals = kind.where("any and not full").select(F.col("src").alias("s"), "target", "lam", none.alias("lo"), none.alias("hi"))
    for _ in range(ROUNDS):
        for _ in range(STEPS):
            # the duals ride along, so that a step reads those of the step before once
            r = CAP / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), F.col("lam") * F.col("z")))))
            given = F.col("n") * F.col("size") * F.col("r")
            d = (hist.join(duals, F.col("src").eqNullSafe(F.col("s"))).withColumn("r", r).groupBy("s").agg(
                *[F.max(c).alias(c) for c in ("target", "lam", "lo", "hi")], F.sum(given).alias("got"),
                F.sum(given * F.col("z") * (1 - F.col("r") / CAP)).alias("slope")))
            over = F.col("got") > F.col("target")
            d = d.withColumns({"lo": F.when(over, F.col("lo")).otherwise(F.col("lam")),
                               "hi": F.when(over, F.col("lam")).otherwise(F.col("hi")),
                               "step": F.col("lam") + F.greatest(F.lit(-4.0), F.least(F.lit(4.0), (F.col("target") - F.col("got")) / F.greatest(F.col("slope"), F.lit(1e-300)))),
                               "done": F.abs(F.col("got") - F.col("target")) <= TOLERANCE * F.col("target")})
            inside = F.coalesce(F.col("step") > F.col("lo"), F.lit(True)) & F.coalesce(F.col("step") < F.col("hi"), F.lit(True))
            duals = d.select("s", "target", F.when(F.col("done"), F.col("lam")).when(inside, F.col("step")).otherwise((F.col("lo") + F.col("hi")) / 2).alias("lam"),
                             "lo", "hi", "done")
        duals = materialize(duals, "duals")
        if duals.where("not done").isEmpty():
            break
        duals = duals.drop("done")
    else:
        raise RuntimeError(f"the duals did not settle in {ROUNDS * STEPS} steps")
    return settled.unionByName(duals.select(F.col("s").alias("src"), "lam", F.lit(False).alias("full")))


ADDED = ("size", "source_size", "target", "taken")


def mix(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes of it)."""
    own = [F.col("own").getField(c).alias(c) for c in docs.columns if c not in ADDED]
    return _mixed(docs, budget).select(*own, *ADDED)


def _mixed(docs: DataFrame, budget: float) -> DataFrame:
    """Rows ``(own, size, source_size, target, taken)``; ``own`` holds the row's columns."""
    key = F.xxhash64(F.col("doc_id"), F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    slim = docs.select(F.struct(*docs.columns).alias("own"), words("text").alias("size"), F.col("source").cast("string").alias("src"), key.alias("_h"))
    hist = slim.groupBy("src", "size", F.shiftrightunsigned("_h", 44).alias("_fine")).agg(F.count("*").alias("n"))
    hist = materialize(hist, "fine-sizes")
    total = hist.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slices = min(1 << 20, pow2_at_least(-(-total // SLICE)))
    sized = hist.groupBy("src", "size").agg(F.sum("n").alias("n"))
    sources = sized.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"), F.sum("n").alias("docs"))
    goals = materialize(targets(sources.select("src", "source_size"), budget), "targets")
    mean = sources.select(F.col("src").alias("s"), (F.col("source_size") / F.col("docs")).alias("mean"))
    cells = materialize(sized.where("size > 0").join(mean, F.col("src").eqNullSafe(F.col("s"))).drop("s")
                        .withColumn("z", F.col("size") / F.col("mean")), "sizes")
    duals = solve(cells, goals)
    rated = (cells.join(duals.withColumnRenamed("src", "s"), F.col("src").eqNullSafe(F.col("s"))).drop("s")
             .withColumn("want", F.col("n") * _rate(F.col("lam"))))
    rated = rated.join(goals.select(F.col("src").alias("s"), "target"), F.col("src").eqNullSafe(F.col("s"))).drop("s")
    by = Window.partitionBy("src").orderBy(F.col("size").desc())
    upto, prior = by.rowsBetween(Window.unboundedPreceding, 0), by.rowsBetween(Window.unboundedPreceding, -1)
    whole = F.floor(F.sum("want").over(upto) + 0.5) - F.floor(F.coalesce(F.sum("want").over(prior), F.lit(0.0)) + 0.5)
    copies = rated.withColumn("k", F.greatest(F.lit(0).cast("long"), F.least((CAP * F.col("n")).cast("long"), whole.cast("long"))))
    copies = copies.withColumn("rest", F.floor("target") - F.sum(F.col("k") * F.col("size")).over(Window.partitionBy("src")))
    # what the rounding left: added to, or taken from, the first sizes that can bear it
    copies = copies.withColumn("room", F.when(F.col("rest") > 0, (CAP * F.col("n") - F.col("k")) * F.col("size")).otherwise(F.col("k") * F.col("size")))
    moved = F.greatest(F.lit(0).cast("long"), F.least(F.col("room"), F.abs("rest") - F.coalesce(F.sum("room").over(prior), F.lit(0))))
    share = copies.withColumn("t", F.col("k") * F.col("size") + F.signum("rest").cast("long") * moved)
    share = share.select(F.col("src").alias("s1"), F.col("size").alias("z1"), F.col("n").alias("_n"),
                         F.expr("t div size").alias("_q"), (F.col("t") % F.col("size")).alias("_rem"))
    at = F.pmod(F.col("_fine"), F.lit(slices)).alias("_slice")
    held = hist.where("size > 0").groupBy("src", "size", at).agg(F.sum("n").alias("m"))
    first = held.select(F.col("src").alias("s2"), F.col("size").alias("z2"), F.col("_slice").alias("_sl"), F.coalesce(F.sum("m").over(
        Window.partitionBy("src", "size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    plan = first.join(share, F.col("s1").eqNullSafe(F.col("s2")) & (F.col("z1") == F.col("z2"))).drop("s1", "z1")
    rows = slim.withColumn("_slice", F.pmod(F.shiftrightunsigned("_h", 44), F.lit(slices)))
    inside = Window.partitionBy("src", "size", "_slice").orderBy("_h", F.col("own").getField("doc_id"))
    rows = rows.withColumn("_r", F.row_number().over(inside)).join(
        plan, F.col("src").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")) & (F.col("_slice") == F.col("_sl")), "left")
    place = F.col("_before") + F.col("_r")
    taken = (F.expr("_q div _n") + (place <= F.col("_q") % F.col("_n")).cast("long")) * F.col("size") + F.when(
        place == F.col("_q") % F.col("_n") + 1, F.col("_rem")).otherwise(0)
    rows = rows.withColumn("taken", F.coalesce(taken, F.lit(0)).cast("long")).join(
        goals.select(F.col("src").alias("s3"), "source_size", "target"), F.col("src").eqNullSafe(F.col("s3")))
    return rows.select("own", *ADDED)


def materialise_copies(docs: DataFrame, budget: float = BUDGET) -> DataFrame:
    """The mixed corpus: each document as often as the mix takes it; a copy taken in part holds its first words."""
    part = F.col("taken") % F.col("size")
    full = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(1)
    parts = F.concat(F.array_repeat(F.lit(-1).cast("long"), full.cast("int")),
                     F.when((F.col("size") > 0) & (part > 0), F.array(part)).otherwise(F.array().cast("array<long>")))
    cut = F.array_join(F.slice(F.regexp_extract_all(F.col("own").getField("text"), F.lit(f"({WORD})")), F.lit(1), F.col("_words").cast("int")), " ")
    whole = F.col("_words") < 0
    out = _mixed(docs, budget).withColumn("_words", F.explode(parts)).withColumn("_cut", F.when(~whole, cut))

    def column(c: str) -> Column:
        mine = F.col("own").getField(c)
        if c == "text":
            return F.when(whole, mine).otherwise(F.col("_cut")).alias(c)
        if c == "n_chars":
            return F.when(whole, mine).otherwise(F.char_length("_cut")).cast(docs.schema[c].dataType).alias(c)
        return mine.alias(c)

    return out.select(*[column(c) for c in docs.columns])
