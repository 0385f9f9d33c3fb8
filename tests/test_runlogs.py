import random

from qaloom.operators import runlogs

SCHEMA = "stage string, session long, step long, metric string, value double"


def test_last_session_wins(spark):
    rows = [("s", 1, 50, "loss", 9.0), ("s", 3, 50, "loss", 7.0), ("s", 2, 50, "loss", 8.0), ("s", 1, 60, "loss", 6.0)]
    curves = runlogs.run_curves(spark.createDataFrame(rows, SCHEMA)).orderBy("step").collect()
    assert [(r.step, r.loss) for r in curves] == [(50, 7.0), (60, 6.0)]
    sessions = {r.session: (r.n_rows, r.first_step, r.last_step, r.superseded_steps)
                for r in runlogs.session_counts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert sessions == {1: (2, 50, 60, 1), 2: (1, 50, 50, 1), 3: (1, 50, 50, 0)}


def test_best_and_retained_checkpoints(spark):
    rng = random.Random(8)
    rows = [(s, 1, step, "eval_loss", float(rng.randint(1, 9))) for s in "ab" for step in rng.sample(range(500), 40)]
    rows += [("a", 1, 900, "loss", 0.1), ("c", 1, 5, "loss", 0.2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    best = {r.stage: (r.best_step, r.best_eval_loss, r.last_eval_step, r.latest_step) for r in runlogs.best_checkpoint(df).collect()}
    kept = {}
    for r in runlogs.keep_last(df, 2).collect():
        kept.setdefault(r.stage, set()).add((r.step, r.is_newest, r.is_best))
    for s in "ab":
        evals = [(v, step) for st, _, step, m, v in rows if st == s and m == "eval_loss"]
        value, step = min(evals)
        newest = sorted((e[1] for e in evals), reverse=True)
        assert best[s] == (step, value, newest[0], 900 if s == "a" else newest[0])
        assert kept[s] == {(x, x in newest[:2], x == step) for x in {*newest[:2], step}}
    assert best["c"] == (None, None, None, 5) and "c" not in kept
