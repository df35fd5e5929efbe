import random

from candleforge.llm.lines import LineRuns, dedup_lines

SP = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SP))


def brute(rows):
    owner = {}
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                k = key(line)
                if len(k) >= 10:
                    owner[k] = min(owner.get(k, i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if i is None or len(key(x)) < 10 or owner[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    rng = random.Random(1)
    pool = ["a common Line here", " A COMMON line HERE\t", "éééééééééé", "ééééééééé", "short", "", "0123456789", "x" * 5000]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.6 else f"own line {rng.random()}" for _ in range(rng.randrange(1, 8)))) for i in range(80)]
    rows += [(None, "a common line here"), (3, None), (200, None), (201, ""), (5, rows[5][1])]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), batches=5).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_extra_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "some long line", "q", 7)], "doc_id long, text string, drops string, h1 long")
    assert dedup_lines(df, keep=("doc_id", "drops")).collect()[0].drops == "q"
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_compact_and_reopen(spark):
    runs = LineRuns(spark, fanout=2)
    for i in range(4):
        runs.add(spark.createDataFrame([(i, f"line number {i} of its own\nthe line they all share")], "doc_id long, text string"))
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    runs.close()  # as in another session: the manifest alone names the runs
    again = LineRuns(spark, runs.folder, fanout=2)
    drops = again.add(spark.createDataFrame([(9, "the line they all share\nline number 2 of its own\nnew and long enough")], "doc_id long, text string"))
    assert [len(r.drops) for r in drops.collect()] == [2]
    again.close()


def test_runs_are_not_shuffled(spark):
    """Merging runs, and a batch that meets one, exchange no row of a run."""
    runs = LineRuns(spark, fanout=9)
    for i in range(2):
        runs.add(spark.createDataFrame([(i, f"line number {i} of its own\nthe line they all share")], "doc_id long, text string"))
    a, b = (runs._run(n) for n in runs.levels[0])
    merged = runs._merged(runs.levels[0])
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()
    new = spark.range(50).selectExpr("id AS h1", "id AS h2").distinct()
    plan = new.join(a.hint("merge"), ["h1", "h2"], "left").join(b.select("h1", "h2").hint("merge"), ["h1", "h2"], "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 2
    assert merged.count() == 3
    runs.close()
