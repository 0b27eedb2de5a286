"""Queries of evaluation and statistics.

The judged runs are read off the event table: users are tasks (thirty skills), a
third of the events belongs to each model, then alternately to the unaided and the
aided arm and to two runs; event types are the rubric's items, values its scores
of 100 at most; errors are no capability item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import scores
from corpusloom.operators import evaluation as ev
from corpusloom.operators.records import read

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


LABELS_SQL = """item AS (SELECT 'tessl-single-lab_skill-' || (user_id % 30) || '_' || (user_id // 30) AS task, 'm' || (event_id % 3) AS model, CASE (event_id // 3) % 2 WHEN 0 THEN 'u' ELSE 'a' END AS arm, (event_id // 6) % 2 AS run, event_type AS item, least(value, 100) / 100 AS s FROM events WHERE event_type <> 'error'),
 i AS (SELECT task, model, arm, run, item, avg(s) AS s FROM item GROUP BY ALL), r AS (SELECT task, model, arm, run, avg(s) AS s FROM i GROUP BY ALL), x AS (SELECT task, model, arm, round(avg(s), 9) AS s FROM r GROUP BY ALL),
 labels AS (SELECT task, regexp_replace(regexp_replace(task, '^tessl-single-', ''), '_[0-9]+$', '') AS skill, model, max(CASE WHEN arm = 'u' THEN s END) AS u, max(CASE WHEN arm = 'a' THEN s END) AS a FROM x GROUP BY ALL),
 gain AS (SELECT task, skill, max(a - u) AS gain FROM labels WHERE model <> 'm0' AND u IS NOT NULL AND a IS NOT NULL GROUP BY ALL)"""
STATE_SQL = "CASE WHEN a >= 0.7 AND u >= 0.7 THEN 'internalized' WHEN a >= 0.7 AND u < 0.4 THEN 'skill works' WHEN a < 0.4 AND u < 0.4 THEN 'uncovered' WHEN u >= 0.7 AND a < 0.4 THEN 'skill hurts' ELSE 'between thresholds' END"
PAIRS_SQL = f"{LABELS_SQL}, pairs AS (SELECT skill, round(avg(u), 9) AS u, round(avg(a), 9) AS a FROM labels WHERE model = 'm0' AND u IS NOT NULL AND a IS NOT NULL AND skill IN (SELECT skill FROM gain WHERE gain > 0.1) GROUP BY skill)"


def labels(spark, sf_dir) -> DataFrame:
    e = read(spark, sf_dir, "events")
    task = F.concat(F.lit("tessl-single-lab_skill-"), (F.col("user_id") % 30).cast("string"), F.lit("_"), F.floor(F.col("user_id") / 30).cast("string"))
    items = e.select(
        task.alias("task"), F.concat(F.lit("m"), (F.col("event_id") % 3).cast("string")).alias("model"),
        F.when(F.floor(F.col("event_id") / 3) % 2 == 0, "u").otherwise("a").alias("arm"), (F.floor(F.col("event_id") / 6) % 2).alias("run"),
        F.col("event_type").alias("item"), F.least("value", F.lit(100.0)).alias("score"), F.lit(100.0).alias("most"),
    )
    return ev.arm_scores(items, items.filter("item <> 'error'"))


@query(f"WITH {LABELS_SQL} SELECT task, model, u, a FROM labels")
def arm_scores(spark, sf_dir):
    """Unaided and aided capability score of every task and model."""
    return labels(spark, sf_dir)


@query(f"WITH {LABELS_SQL} SELECT task, round(gain, 9) AS gain, gain > 0.1 AS valid FROM gain")
def validity_gate(spark, sf_dir):
    """Tasks on which some witness model gains more than the gate asks."""
    rows = ev.gains(labels(spark, sf_dir), "m0")
    return rows.select("task", F.round("gain", 9).alias("gain"), (F.col("gain") > ev.GAMMA).alias("valid"))


@query(f"""WITH {LABELS_SQL}, d AS (SELECT l.skill, string_agg(l.task, ';' ORDER BY l.task) AS tasks, count(*) AS n, round(avg(u), 6) AS u, round(avg(a), 6) AS a, round(max(gain), 6) AS gain FROM labels l LEFT JOIN gain g USING (task) WHERE model = 'm0' AND u IS NOT NULL GROUP BY l.skill)
SELECT skill, tasks, u, a, gain, CASE WHEN abs(u - 0.8) <= 0.2 + 1e-9 AND n < 3 THEN 'extra_tasks' WHEN u >= 0.8 AND coalesce(gain > 0.1, false) THEN 'retire' WHEN u >= 0.8 THEN 'regenerate' WHEN u < 0.4 AND a IS NULL THEN 'measure_aided' WHEN u < 0.4 AND a < 0.4 THEN 'keep_repair' ELSE 'keep' END AS verdict FROM d""")
def retire_decisions(spark, sf_dir):
    """The decision on every skill for one deployment model."""
    return ev.decisions(labels(spark, sf_dir), "m0")


@query(f"""WITH {LABELS_SQL}, d AS (SELECT skill, round(avg(u), 6) AS u, round(avg(a), 6) AS a, count(*) AS n, round(max(gain), 6) AS gain FROM labels l LEFT JOIN gain g USING (task, skill) WHERE model = 'm0' AND u IS NOT NULL GROUP BY skill)
SELECT CASE WHEN abs(u - 0.8) <= 0.2 + 1e-9 AND n < 3 THEN 'extra_tasks' WHEN u >= 0.8 AND coalesce(gain > 0.1, false) THEN 'retire' WHEN u >= 0.8 THEN 'regenerate' WHEN u < 0.4 AND a IS NULL THEN 'measure_aided' WHEN u < 0.4 AND a < 0.4 THEN 'keep_repair' ELSE 'keep' END AS verdict, count(*) AS n FROM d GROUP BY 1""")
def verdict_counts(spark, sf_dir):
    return ev.decisions(labels(spark, sf_dir), "m0").groupBy("verdict").agg(F.count("*").alias("n"))


@query(f"WITH {PAIRS_SQL} SELECT skill, u, a, {STATE_SQL} AS state FROM pairs")
def skill_states(spark, sf_dir):
    """State of every skill that passed the gate."""
    return ev.gated_pairs(labels(spark, sf_dir), "m0").select("skill", "u", "a", ev.state(F.col("u"), F.col("a")).alias("state"))


@query(f"""WITH {PAIRS_SQL}, s AS (SELECT u, a, {STATE_SQL} AS state FROM pairs), f AS (SELECT state, unnest([{{'rule': 'gain < 0', 'r': a - u < 0}}, {{'rule': 'gain <= 0', 'r': a - u <= 0}}, {{'rule': '|gain| < 0.10', 'r': abs(a - u) < 0.10}}, {{'rule': '|gain| < 0.10, A >= 0.7', 'r': abs(a - u) < 0.10 AND a >= 0.7}}, {{'rule': 'U >= 0.8', 'r': u >= 0.8}}]) AS x FROM s)
SELECT x.rule AS rule, count(*) AS skills, coalesce(round(count_if(x.r)::double / count(*), 9), 0) AS retired, CASE WHEN count_if(x.r) > 0 THEN round(count_if(x.r AND state = 'uncovered')::double / count_if(x.r), 9) ELSE 0 END AS uncovered_share,
 CASE WHEN count_if(state = 'uncovered') > 0 THEN round(count_if(x.r AND state = 'uncovered')::double / count_if(state = 'uncovered'), 9) ELSE 0 END AS uncovered_removed, CASE WHEN count_if(state = 'internalized') > 0 THEN round(count_if(x.r AND state = 'internalized')::double / count_if(state = 'internalized'), 9) ELSE 0 END AS internalized_removed FROM f GROUP BY 1""")
def rule_audit(spark, sf_dir):
    """What each retirement rule would remove."""
    return ev.audit(ev.gated_pairs(labels(spark, sf_dir), "m0"))


@query(f"""WITH {LABELS_SQL}, m AS (SELECT avg((u >= 0.5) = (a >= 0.5)) AS p, avg((u >= 0.5)::int) AS px, avg((a >= 0.5)::int) AS py FROM (SELECT u >= 0.5 AS x, u, a FROM labels WHERE u IS NOT NULL AND a IS NOT NULL)), c AS (SELECT *, px * py + (1 - px) * (1 - py) AS ch FROM m)
SELECT round(p, 9) AS agreement, CASE WHEN ch < 1 THEN round((p - ch) / (1 - ch), 9) ELSE 1 END AS kappa FROM c""".replace("avg((u >= 0.5) = (a >= 0.5))", "avg(((u >= 0.5) = (a >= 0.5))::int)"))
def kappa(spark, sf_dir):
    """Agreement of the two arms on which tasks are half solved."""
    rows = labels(spark, sf_dir).filter("u IS NOT NULL AND a IS NOT NULL")
    return ev.kappa(rows, F.col("u") >= 0.5, F.col("a") >= 0.5)


@query(f"""WITH {LABELS_SQL}, h AS (SELECT task, model, u, a, right(task, 1) AS half FROM labels WHERE u IS NOT NULL AND a IS NOT NULL), p AS (SELECT x.u AS ux, x.a AS ax, y.u AS uy, y.a AS ay FROM h x JOIN h y ON x.model = y.model AND x.half = '0' AND y.half = '1' AND regexp_replace(x.task, '_0$', '') = regexp_replace(y.task, '_1$', '')),
 b AS (SELECT ux AS u1, ax AS a1, uy AS u2, ay AS a2 FROM p UNION ALL SELECT uy, ay, ux, ax FROM p) SELECT rule, count(*) AS n, round(avg((u2 < 0.4 AND a2 < 0.4)::int), 9) AS uncovered_rate FROM (SELECT unnest(list_filter([CASE WHEN abs(a1 - u1) < 0.1 THEN 'band' END, CASE WHEN u1 >= 0.5 THEN 'level' END], lambda z: z IS NOT NULL)) AS rule, u2, a2 FROM b) GROUP BY rule""")
def cross_fit_audit(spark, sf_dir):
    """Rules chosen on one task of a skill and judged on its other one, in both directions."""
    rows = labels(spark, sf_dir).filter("u IS NOT NULL AND a IS NOT NULL")
    half = lambda k, n: rows.filter(F.col("task").endswith(f"_{k}")).select(F.regexp_replace("task", r"_\d+\z", "").alias("skill"), "model", F.col("u").alias(f"u{n}"), F.col("a").alias(f"a{n}"))
    one = half(0, 1).join(half(1, 2), ["skill", "model"])
    both = one.select("u1", "a1", "u2", "a2").unionByName(one.select(F.col("u2").alias("u1"), F.col("a2").alias("a1"), F.col("u1").alias("u2"), F.col("a1").alias("a2")))
    named = F.filter(F.array(F.when(F.abs(F.col("a1") - F.col("u1")) < 0.1, F.lit("band")), F.when(F.col("u1") >= 0.5, F.lit("level"))), lambda z: z.isNotNull())
    return both.select(F.explode(named).alias("rule"), "u2", "a2").groupBy("rule").agg(F.count("*").alias("n"), F.round(F.avg(((F.col("u2") < 0.4) & (F.col("a2") < 0.4)).cast("double")), 9).alias("uncovered_rate"))


@query("""WITH t AS (SELECT user_id, count(*) AS n, count_if(value >= 50)::bigint AS c FROM events GROUP BY 1), k AS (SELECT unnest([1, 2, 3]) AS k),
 p AS (SELECT k, CASE WHEN n < k THEN 0 WHEN n - c < k THEN 1.0 ELSE 1 - (CASE k WHEN 1 THEN (n - c)::double / n WHEN 2 THEN (n - c)::double / n * (n - c - 1) / (n - 1) ELSE (n - c)::double / n * (n - c - 1) / (n - 1) * (n - c - 2) / (n - 2) END) END AS one,
  CASE WHEN n < k OR c < k THEN 0 ELSE (CASE k WHEN 1 THEN c::double / n WHEN 2 THEN c::double / n * (c - 1) / (n - 1) ELSE c::double / n * (c - 1) / (n - 1) * (c - 2) / (n - 2) END) END AS every FROM t, k)
SELECT k, round(avg(one), 6) AS pass_at, round(avg(every), 6) AS pass_hat, count_if(one >= 1 - 1e-9)::bigint AS pass_at_count, count_if(every >= 1 - 1e-9)::bigint AS pass_hat_count FROM p GROUP BY k""")
def pass_at_k(spark, sf_dir):
    """Unbiased chances that one, or every one, of k runs is right, averaged over tasks; fewer than k runs count 0."""
    tasks = read(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("value") >= 50).alias("c"))
    rows = tasks.select("n", "c", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k"))
    one = F.coalesce(scores.pass_at_k(F.col("n"), F.col("c"), F.col("k")), F.lit(0.0))
    every = F.coalesce(scores.pass_hat_k(F.col("n"), F.col("c"), F.col("k")), F.lit(0.0))
    return rows.groupBy("k").agg(F.round(F.avg(one), 6).alias("pass_at"), F.round(F.avg(every), 6).alias("pass_hat"), F.count_if(one >= 1 - 1e-9).alias("pass_at_count"), F.count_if(every >= 1 - 1e-9).alias("pass_hat_count"))


@query("""WITH t AS (SELECT user_id, avg(CASE WHEN event_type = 'click' THEN least(value, 100) / 100 END) AS au, avg(CASE WHEN event_type = 'view' THEN least(value, 100) / 100 END) AS j FROM events GROUP BY 1)
SELECT user_id, round((au * 0.5 + CASE WHEN au < 0.75 THEN 0 ELSE j END * 0.5) / 1.0, 9) AS score, round((au * 0.5 + j * 0.5) / 1.0, 9) AS simple FROM t""")
def hybrid_grade(spark, sf_dir):
    """Automated and judged scores combined; the judge counts only where the automated score suffices."""
    mean = lambda kind: F.avg(F.when(F.col("event_type") == kind, F.least("value", F.lit(100.0)) / 100))
    rows = read(spark, sf_dir, "events").groupBy("user_id").agg(mean("click").alias("au"), mean("view").alias("j"))
    grade = ev.hybrid_grade(F.col("au"), F.col("j"), F.lit(0.5), F.lit(0.5))
    return rows.select("user_id", F.round(grade["score"], 9).alias("score"), F.round(grade["simple"], 9).alias("simple"))


@query("""WITH r AS (SELECT user_id, CASE event_type WHEN 'error' THEN -2.0 WHEN 'click' THEN 2.0 ELSE 1.0 END AS score, CASE WHEN value < 0.05 THEN NULL WHEN value >= 40 THEN 1 ELSE 0 END AS met FROM events)
SELECT user_id, CASE WHEN count_if(met IS NULL) = 0 AND sum(greatest(score, 0)) > 0 THEN round(greatest(0, least(1, sum(score * met) / sum(greatest(score, 0)))), 9) END AS reward FROM r GROUP BY 1""")
def rubric_reward(spark, sf_dir):
    """Met rubric scores over the positive ones; null where a verdict is missing."""
    kind = F.col("event_type")
    rows = read(spark, sf_dir, "events").select(
        "user_id", F.when(kind == "error", -2.0).when(kind == "click", 2.0).otherwise(1.0).alias("score"),
        F.when(F.col("value") >= 40, 1.0).when(F.col("value") >= 0.05, 0.0).alias("met"),
    )
    return ev.rubric_reward(rows, "user_id")


@query("""WITH t AS (SELECT user_id, avg(CASE WHEN value >= 1 THEN 1.0 ELSE 0 END) AS m FROM events GROUP BY 1) SELECT round(avg((m >= 1 - 1e-9)::int), 9) AS rate, count_if(m >= 1 - 1e-9)::bigint AS perfect, count(*) AS tasks FROM t""")
def strict_accuracy(spark, sf_dir):
    """Share of tasks with a perfect mean score."""
    rows = read(spark, sf_dir, "events").groupBy("user_id").agg(F.avg(F.when(F.col("value") >= 1, 1.0).otherwise(0.0)).alias("m"))
    perfect = F.col("m") >= 1 - 1e-9
    return rows.agg(F.round(F.avg(perfect.cast("double")), 9).alias("rate"), F.count_if(perfect).alias("perfect"), F.count("*").alias("tasks"))


@query("""WITH t AS (SELECT user_id, avg(value) AS x, count(*) AS y FROM events GROUP BY 1), e AS (SELECT quantile_cont(x, 0.2) AS a, quantile_cont(x, 0.4) AS b, quantile_cont(x, 0.6) AS c, quantile_cont(x, 0.8) AS d FROM t)
SELECT CASE WHEN x < a THEN 1 WHEN x < b THEN 2 WHEN x < c THEN 3 WHEN x < d THEN 4 ELSE 5 END AS fifth, count(*) AS n, round(avg(y), 6) AS mean_events FROM t, e GROUP BY 1""")
def quantile_fifths(spark, sf_dir):
    """Bands by value, not by rank: fifths of the users' mean values, the last one closed."""
    rows = read(spark, sf_dir, "events").groupBy("user_id").agg(F.avg("value").alias("x"), F.count("*").alias("y"))
    a, b, c, d = rows.agg(F.percentile("x", F.array(*[F.lit(p) for p in (0.2, 0.4, 0.6, 0.8)]))).first()[0]
    x = F.col("x")
    return rows.groupBy(F.when(x < a, 1).when(x < b, 2).when(x < c, 3).when(x < d, 4).otherwise(5).alias("fifth")).agg(F.count("*").alias("n"), F.round(F.avg("y"), 6).alias("mean_events"))


@query("""WITH t AS (SELECT user_id, avg(value) AS x, count(*) AS y FROM events GROUP BY 1), m AS (SELECT quantile_cont(x, 0.5) AS q FROM t) SELECT user_id, x >= q AS above, CASE WHEN x >= q THEN y ELSE 0 END AS gated FROM t, m""")
def median_gate(spark, sf_dir):
    """Users at or above the median take the one measure, the others none."""
    rows = read(spark, sf_dir, "events").groupBy("user_id").agg(F.avg("value").alias("x"), F.count("*").alias("y"))
    q = rows.agg(F.percentile("x", F.lit(0.5))).first()[0]
    return rows.select("user_id", (F.col("x") >= q).alias("above"), F.when(F.col("x") >= q, F.col("y")).otherwise(0).alias("gated"))


@query("""WITH t AS (SELECT user_id, avg(value) AS x, count(*) AS y, avg(hour(ts)) AS z FROM events GROUP BY 1), c AS (SELECT corr(x, y) AS xy, corr(x, z) AS xz, corr(y, z) AS yz FROM t) SELECT round((xy - xz * yz) / sqrt((1 - xz * xz) * (1 - yz * yz)), 6) AS partial FROM c""")
def partial_corr(spark, sf_dir):
    """Correlation of two measures after a third is regressed out of both (with intercept)."""
    rows = read(spark, sf_dir, "events").groupBy("user_id").agg(F.avg("value").alias("x"), F.count("*").alias("y"), F.avg(F.hour("ts")).alias("z"))
    slopes = rows.agg(*[F.covar_pop(v, "z").alias(f"c{v}") for v in "xy"], F.var_pop("z").alias("vz"), *[F.avg(v).alias(f"m{v}") for v in "xyz"]).first()
    rest = lambda v: F.col(v) - slopes[f"m{v}"] - (slopes[f"c{v}"] / slopes["vz"] if slopes["vz"] else 0.0) * (F.col("z") - slopes["mz"])
    return rows.agg(F.round(F.corr(rest("x"), rest("y")), 6).alias("partial"))


@query("""WITH e AS (SELECT label, unnest(embedding::double[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(v) AS v FROM e GROUP BY ALL)
SELECT label, i::int AS i, round(v, 9) AS v FROM m""")
def vector_group_mean(spark, sf_dir):
    """Mean vector of every label, one row per dimension."""
    rows = read(spark, sf_dir, "embeddings").select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "v"))
    return rows.groupBy("label", (F.col("i") + 1).alias("i")).agg(F.round(F.avg("v"), 9).alias("v"))


@query("""WITH e AS (SELECT label, unnest(embedding::double[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id % 2 = 1), m AS (SELECT label, i, avg(v) AS v FROM e GROUP BY ALL),
 b AS (SELECT vec_id, label, unnest(embedding::double[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE vec_id % 2 = 0), x AS (SELECT vec_id, i, 0.7 * b.v + 0.3 * coalesce(m.v, 0) AS y, m.v IS NULL AS bare, b.v AS base FROM b LEFT JOIN m USING (label, i)),
 n AS (SELECT vec_id, sqrt(sum(y * y)) AS len FROM x GROUP BY 1) SELECT vec_id, round(sum(CASE WHEN bare THEN base ELSE y / len END * i), 6) AS checksum FROM x JOIN n USING (vec_id) GROUP BY 1""")
def expansion_mix(spark, sf_dir):
    """Half of the vectors mixed with the mean of the other half of their label (weight 0.3), at unit length."""
    from corpusloom.functions import vectors

    rows = read(spark, sf_dir, "embeddings")
    extra = vectors.group_mean(rows.filter("vec_id % 2 = 1"), "label", "embedding")
    mixed = rows.filter("vec_id % 2 = 0").join(extra, "label", "left").select("vec_id", vectors.blend(F.col("embedding"), F.col("mean"), 0.3).alias("v"))
    return mixed.select("vec_id", F.round(F.aggregate(F.transform("v", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x), 6).alias("checksum"))


@query()
def background_projection(spark, sf_dir):
    """Vectors without their two leading background directions, at unit length; what is left along them is 0."""
    from corpusloom.functions import vectors

    rows = read(spark, sf_dir, "embeddings")
    basis = vectors.leading_directions(rows, "embedding", 2)
    cleaned = rows.select("vec_id", vectors.project_out(F.col("embedding"), basis, rescale=True).alias("v"))
    first = F.array(*[F.lit(float(x)) for x in basis[0]])
    return cleaned.select("vec_id", F.round(vectors.norm(F.col("v")), 6).alias("length"), F.round(F.abs(vectors.dot(F.col("v"), first)), 6).alias("along"))
