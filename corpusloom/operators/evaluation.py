"""Two-arm evaluation: capability scores, validity gates, states, decisions, audits; grading.

Scores are means of means (items in a run, runs in an arm); a run without scored
items has no score.  Means are rounded to nine digits, so thresholds behave alike
in any order of rows.  Nulls: a missing arm leaves its score null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of states, gate and decisions.
HIGH, LOW, GAMMA = 0.7, 0.4, 0.1
TAU, MARGIN, MAX_TASKS, EPSILON = 0.8, 0.2, 3, 1e-9
TASK_PREFIX = "tessl-single-"


def skill_of(task: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(task, f"^{TASK_PREFIX}", ""), r"_\d+\z", "")


def arm_scores(items: DataFrame, capability: DataFrame) -> DataFrame:
    """``(task, model, u, a)`` from ``items(task, model, arm, run, item, score, most)``
    (arms ``u`` unaided and ``a`` aided) and ``capability(task, item)``."""
    share = F.when(F.col("most") != 0, F.col("score") / F.col("most")).otherwise(0.0)
    rows = items.join(capability.select("task", "item").distinct(), ["task", "item"], "left_semi")
    per_item = rows.groupBy("task", "model", "arm", "run", "item").agg(F.avg(share).alias("s"))
    per_run = per_item.groupBy("task", "model", "arm", "run").agg(F.avg("s").alias("s"))
    per_arm = per_run.groupBy("task", "model", "arm").agg(F.round(F.avg("s"), 9).alias("s"))
    arm = lambda name: F.max(F.when(F.col("arm") == name, F.col("s"))).alias(name)
    return per_arm.groupBy("task", "model").agg(arm("u"), arm("a"))


def gains(labels: DataFrame, target: str) -> DataFrame:
    """Per task the largest gain of a witness (a model other than the target) and the number of witnesses."""
    rows = labels.filter((F.col("model") != target) & F.col("u").isNotNull() & F.col("a").isNotNull())
    return rows.groupBy("task").agg(F.max(F.col("a") - F.col("u")).alias("gain"), F.count("*").alias("witnesses"))


def state(u: Column, a: Column) -> Column:
    return (
        F.when((a >= HIGH) & (u >= HIGH), "internalized").when((a >= HIGH) & (u < LOW), "skill works").when((a < LOW) & (u < LOW), "uncovered")
        .when((u >= HIGH) & (a < LOW), "skill hurts").otherwise("between thresholds")
    )


def verdict(u: Column, gain: Column, a: Column, tasks: Column, regenerated: Column) -> Column:
    """The next step for a skill, as in the decision ladder."""
    gained = F.coalesce(gain > GAMMA, F.lit(False))
    return (
        F.when((F.abs(u - TAU) <= MARGIN + EPSILON) & (tasks < MAX_TASKS), "extra_tasks")
        .when((u >= TAU) & gained, "retire").when((u >= TAU) & ~regenerated, "regenerate").when(u >= TAU, "keep_no_verdict")
        .when((u < LOW) & a.isNull(), "measure_aided").when((u < LOW) & (a < LOW), "keep_repair").otherwise("keep")
    )


def decisions(labels: DataFrame, target: str) -> DataFrame:
    """``(skill, tasks, u, a, gain, verdict)`` of every skill the target model was scored on."""
    own = labels.filter((F.col("model") == target) & F.col("u").isNotNull())
    met = own.join(gains(labels, target), "task", "left")
    rows = met.groupBy(skill_of(F.col("task")).alias("skill")).agg(
        F.array_join(F.array_sort(F.collect_set("task")), ";").alias("tasks"), F.count("*").alias("_n"),
        F.round(F.avg("u"), 6).alias("u"), F.round(F.avg("a"), 6).alias("a"), F.round(F.max("gain"), 6).alias("gain"),
    )
    return rows.withColumn("verdict", verdict(F.col("u"), F.col("gain"), F.col("a"), F.col("_n"), F.lit(False))).drop("_n")


def gated_pairs(labels: DataFrame, target: str, gamma: float = GAMMA) -> DataFrame:
    """``(skill, u, a)`` of the target for every skill with a witness gain above ``gamma`` on one of its tasks."""
    own = labels.filter((F.col("model") == target) & F.col("u").isNotNull() & F.col("a").isNotNull())
    means = own.groupBy(skill_of(F.col("task")).alias("skill")).agg(F.round(F.avg("u"), 9).alias("u"), F.round(F.avg("a"), 9).alias("a"))
    passed = gains(labels, target).filter(F.col("gain") > gamma).select(skill_of(F.col("task")).alias("skill")).distinct()
    return means.join(passed, "skill", "left_semi")


def rules() -> dict[str, Column]:
    """Retirement rules by name, over columns ``u`` and ``a``; callers may add their own."""
    u, a = F.col("u"), F.col("a")
    band = F.abs(a - u) < 0.10
    return {"gain < 0": a - u < 0, "gain <= 0": a - u <= 0, "|gain| < 0.10": band, "|gain| < 0.10, A >= 0.7": band & (a >= 0.7), "U >= 0.8": u >= TAU}


def audit(pairs: DataFrame, chosen: dict[str, Column] | None = None) -> DataFrame:
    """Per rule the shares it retires: of all, of what it retires the uncovered, and of
    the uncovered and the internalized; empty denominators give 0."""
    flags = F.array(*[F.struct(F.lit(n).alias("rule"), F.coalesce(c, F.lit(False)).alias("retires")) for n, c in (chosen or rules()).items()])
    rows = pairs.select(state(F.col("u"), F.col("a")).alias("state"), F.explode(flags).alias("x")).select("state", "x.rule", "x.retires")
    both = lambda s: F.count_if(F.col("retires") & (F.col("state") == s))
    share = lambda x, y: F.when(y > 0, F.round(x / y, 9)).otherwise(0.0)
    retired = F.count_if("retires")
    return rows.groupBy("rule").agg(
        F.count("*").alias("skills"), share(retired, F.count("*")).alias("retired"), share(both("uncovered"), retired).alias("uncovered_share"),
        share(both("uncovered"), F.count_if(F.col("state") == "uncovered")).alias("uncovered_removed"), share(both("internalized"), F.count_if(F.col("state") == "internalized")).alias("internalized_removed"),
    )


def kappa(rows: DataFrame, x: Column, y: Column) -> DataFrame:
    """Agreement of two yes-no ratings and Cohen's kappa (1 where chance alone agrees wholly)."""
    means = rows.agg(F.avg((x == y).cast("double")).alias("p"), F.avg(x.cast("double")).alias("px"), F.avg(y.cast("double")).alias("py"))
    chance = F.col("px") * F.col("py") + (1 - F.col("px")) * (1 - F.col("py"))
    return means.select(F.round("p", 9).alias("agreement"), F.when(chance < 1, F.round((F.col("p") - chance) / (1 - chance), 9)).otherwise(1.0).alias("kappa"))


# ---- grading


def hybrid_grade(automated: Column, judged: Column, automated_weight: Column, judged_weight: Column, least: float = 0.75) -> Column:
    """Struct ``(score, simple)``: weighted mean, in ``score`` without the judge's part where the automated score is below ``least``."""
    none = automated_weight + judged_weight <= 0
    wa, wj = F.when(none, 0.5).otherwise(automated_weight), F.when(none, 0.5).otherwise(judged_weight)
    mean = lambda j: (automated * wa + j * wj) / (wa + wj)
    return F.struct(mean(F.when(automated < least, 0.0).otherwise(judged)).alias("score"), mean(judged).alias("simple"))


def rubric_reward(rubric: DataFrame, task: str) -> DataFrame:
    """``(task, reward)`` of ``rubric(task, score, met)``: met scores over positive scores,
    held to 0-1; null where a criterion has no verdict or no score is positive."""
    positive = F.sum(F.when(F.col("score") > 0, F.col("score")).otherwise(0.0))
    got = F.sum(F.col("score") * F.col("met"))
    reward = F.when((F.count_if(F.col("met").isNull()) == 0) & (positive > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), got / positive)))
    return rubric.groupBy(task).agg(F.round(reward, 9).alias("reward"))
