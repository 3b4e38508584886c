from collections import defaultdict

from rows import documents, frame, same
from shopgauge.llm import mixing


def targets(sizes: dict) -> dict:
    """Water filling, one round after the other."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        rate = left / sum(weight[s] for s in free)
        full = {s for s in free if 2 * sizes[s] <= rate * weight[s]}
        if not full:
            return out | {s: rate * weight[s] for s in free}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= full
    return out


def test_targets_and_taken_words(spark):
    rows = documents() + [(1000 + i, "w " * (1 + i % 7), "en", f"s{i % 5}", 0) for i in range(400)]
    df = mixing.mix_report(frame(spark, rows))
    got = df.collect()
    size, taken, biggest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r.doc_id]
        size[s] += r["size"]
        taken[s] += r.taken
        biggest[s] = max(biggest[s], r["size"])
        target[s] = r.target
        assert r.taken in (0, r["size"], 2 * r["size"])
    want = targets(size)
    assert all(abs(target[s] - want[s]) < 1e-6 for s in want)
    # Repeated ids are taken together, so a source may miss by one document or such a pair.
    assert all(abs(taken[s] - target[s]) <= 2 * biggest[s] for s in want)
    assert same(df, mixing.mix_report(frame(spark, rows, extra=True)))


def test_documents_repeat_as_taken(spark):
    report = {r.doc_id: r for r in mixing.mix_report(frame(spark)).collect() if r["size"]}
    mixed = defaultdict(int)
    for r in mixing.mix_documents(frame(spark)).collect():
        mixed[r.doc_id] += 1
    once = {r[0] for r in documents()} - {25}
    assert all(mixed[i] == report[i].taken // report[i]["size"] for i in once & set(report))


def test_empty_and_pure_frames(spark):
    assert mixing.mix_report(frame(spark, [])).count() == 0
    assert mixing.mix_documents(frame(spark, [])).count() == 0
    zero = mixing.mix_report(frame(spark, [(1, None, None, None, 0), (2, "", None, "a", 0)]))
    assert [(r["size"], r.taken) for r in zero.collect()] == [(0, 0), (0, 0)]
    plan = mixing.mix_report(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
