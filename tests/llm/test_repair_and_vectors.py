import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pairloom.llm import pivots, queries, repair, whitening
from pairloom.session import table
from tests.conftest import SF

LEGAL = re.compile("(s?(ua)+)?")
TURNS = "conv_id long, turn long, role string, text string, audit string, `head` int, dropped boolean"


def every_repair(turns, most_inserts=3):
    """All edits of a few turns (initial, faulty, truncated), tried one by one: the cheapest, the first in ASCII order."""
    found = []
    choices = [["D"] if faulty else ["D", "K", "Ru", "Ra"] for _, faulty, _ in turns]
    for edits in itertools.product(*choices):
        for where in (w for n in range(most_inserts + 1) for w in itertools.combinations_with_replacement(range(len(turns) + 1), n)):
            for names in itertools.product("ua", repeat=len(where)):
                audit, roles, cost = "", "", 3 * len(where)
                for i in range(len(turns) + 1):
                    mine = [x for w, x in zip(where, names, strict=True) if w == i]
                    audit, roles = audit + "I" * len(mine), roles + "".join(mine)
                    if i < len(turns):
                        e = edits[i]
                        audit += e[0]
                        roles += "" if e == "D" else turns[i][0] if e == "K" else e[1]
                        cost += {"D": 4, "K": 0, "R": 3}[e[0]] + (3 if turns[i][2] and e != "D" else 0)
                if LEGAL.fullmatch(roles):
                    found.append((cost, audit))
    return min(found)


def slow_repair(turns):
    """From the end: what each place costs from there on; then forward, always the first letter that is still cheapest."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    made = {s: next(iter(set(after[s].values()) - {1})) for s in after}
    cost = [{s: 10**9 for s in after} for _ in range(len(turns) + 1)]
    for i in range(len(turns), -1, -1):
        for s in after:
            if i == len(turns):
                cost[i][s] = 0 if s in (0, 3) else 10**9
            else:
                cost[i][s] = min(c + cost[i + 1][t] for _, c, t in moves(turns[i], s, after, made))
        for _ in range(3):
            for s in after:
                cost[i][s] = min(cost[i][s], 3 + cost[i][made[s]])
    i, s, audit = 0, 0, ""
    while i < len(turns) or cost[i][s]:
        steps = [("I", 3, made[s], 0)] + ([(e, c, t, 1) for e, c, t in moves(turns[i], s, after, made)] if i < len(turns) else [])
        e, _, s, on = min(x for x in steps if x[1] + cost[i + x[3]][x[2]] == cost[i][s])
        audit, i = audit + e, i + on
    return cost[0][0], audit


def moves(turn, s, after, made):
    initial, faulty, truncated = turn
    yield "D", 4, s
    if not faulty:
        if initial in after[s]:
            yield "K", 3 * truncated, after[s][initial]
        yield "R", 3 + 3 * truncated, made[s]


def fast_repair(turns):
    r = repair.Repair()
    for t in turns:
        r.turn(*t)
    return r.result()


def test_repairs_equal_all_repairs_tried():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 3, 3, 3, 3, 3, 3, 3):
        turns = [(rng.choice("suaax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
        assert fast_repair(turns) == every_repair(turns), turns


def test_repairs_of_long_conversations(monkeypatch):
    rng = random.Random(4)
    for flush, n in ((8192, 300), (16, 300), (16, 40), (8192, 7)):
        monkeypatch.setattr(repair, "FLUSH", flush)
        for _ in range(30):
            roles = rng.choice(["suaat", "u", "a", "ua", "uuuas", "s", ""]) or ["", "x"]
            turns = [(rng.choice(roles), rng.random() < rng.choice([0, 0.2, 0.9]), rng.random() < rng.choice([0, 0.4])) for _ in range(n)]
            assert fast_repair(turns) == slow_repair(turns)


def test_audits_are_compared_as_strings(monkeypatch):
    def check():
        a, rng, nodes = repair.Audits(), random.Random(5), [0]
        for _ in range(400):
            nodes.append(a.add(rng.choice(nodes[-6:]), rng.choice("DK")))
        for x, y in (rng.sample(nodes, 2) for _ in range(2000)):
            assert a.less(x, y) == (a.text(x) < a.text(y))
            assert a.equal(x, y) == (a.text(x) == a.text(y))

    check()
    monkeypatch.setattr(repair, "_MOD", 3)  # nearly every hash is that of other strings, too
    check()


def slow_op11(rows):
    space = lambda v: " " if v is None else str(v)
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        kind, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        groups[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    out = set()
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.md5(t[2].encode()).hexdigest()))
        seen, faults, given = set(), [0, 0, 0, 0], []
        for _, role, text in turns:
            last = text.strip(" \t\n\x0b\x0c\r")[-1:]
            fault = 1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0
            seen.add((role, text))
            faults[fault] += 1
            given.append((role[:1], fault in (1, 2), fault == 3))
        cost, audit = slow_repair(given)
        lines, s, i = [], 0, 0
        for e in audit:
            nxt = {0: 2, 1: 2, 2: 3, 3: 2}[s]
            if e == "K":
                s = {"s": 1, "u": 2, "a": 3}[turns[i][1][0]]
                lines.append(f"{turns[i][1]}:{turns[i][2]}")
            elif e in "RI":
                s = nxt
                lines.append(f"{'user' if s == 2 else 'assistant'}:{turns[i][2] if e == 'R' else ''}")
            i += e != "I"
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        out.add((conv, gaps, *faults[1:], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def test_op11_by_hand(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = {tuple(r) for r in queries.op11_conversation_repair(spark, SF).collect()}
    assert found == slow_op11(rows)


def test_op11_hard_rows(spark):
    rng = random.Random(6)
    texts = [None, "", " \t\n", "é.", "Yes!", "no", "what ? \r\n", "\x00.", "x" * 100_000, "."]
    rows = [(rng.choice([None, 1, 2, 3, -4]), rng.choice([None, 0, 1, 2, 3, 9, -7]), rng.choice([None, "", "user", "assistant", "system", "tool", "User"]), rng.choice(texts)) for _ in range(300)]
    rows += [(50, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)] + [(7, 10**17, "user", "a."), (8, None, "user", "b.")]
    given = spark.createDataFrame([(*r, "x", 1, None) for r in rows], TURNS)
    for turns in (given, given.limit(0)):
        damaged = repair.damage(turns)
        found = {tuple(r) for r in repair.repair(damaged).collect()}
        assert found == (slow_op11(rows) if turns is given else set())


def slow_whitening(vectors, counts=False):
    x = np.floor(256 * np.array(vectors, float)).astype(np.int64)
    fit, at, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    w = n if counts else np.ones_like(n)
    total, s = int(w.sum()), (w[:, None] * fit).sum(0)
    c = fit - s / total
    e, axes = np.linalg.eigh((c * w[:, None]).T @ c / total)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(4, x.shape[1])
    z = (c @ axes[:, :k] / np.sqrt(e[:k]))[at.ravel()]
    return total, ((total * x - s) ** 2).sum(1), z, (e / e.sum())[:k]


@pytest.mark.parametrize("counts", [False, True])
def test_op12_against_numpy(spark, counts):
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    rows = rows + rows[:9] * 7 + [(10_000 + r.vec_id, [v + 1e-9 for v in r.embedding]) for r in rows[20:25]]
    made = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), multiplicity=counts)
    found = sorted(made.select("vec_id", "n", "deviation", "z", "explained", "identity_error").collect())
    rows = sorted((r[0], list(r[1])) for r in rows)
    total, deviation, z, explained = slow_whitening([np.array(v, np.float32) for _, v in rows], counts)
    assert [r.vec_id for r in found] == [i for i, _ in rows] and {r.n for r in found} == {total}
    assert [r.deviation for r in found] == deviation.tolist()
    mine = np.array([r.z for r in found])
    assert np.allclose(mine * np.sign((mine * z).sum(0)), z, rtol=1e-9, atol=1e-9)
    assert np.allclose(found[0].explained, explained, rtol=1e-10) and found[0].identity_error < 1e-10


def test_op12_query(spark):
    found = queries.op12_whitening(spark, SF)
    n = table(spark, SF, "embeddings").count()
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = found.collect()
    assert len(rows) == 4 * n and {r.component for r in rows} == {1, 2, 3, 4} and len({r.identity_error for r in rows}) == 1
    assert all(sum(r.whitened**2 for r in rows if r.component == c) == pytest.approx(n, rel=1e-6) for c in (1, 2, 3, 4))


def test_op12_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [None, 1.0], [nan, 0.0], [inf, 1.0], [], [], [1.0], [1.0], [-0.0, 0.0], [0.0, 0.0], [0.5, 0.25], [0.25, -0.001], [3.0, 3.0, 3.0], [3e38, 1.0, 1.0, 1.0], [-3e38, 1.0, 0.0, 1.0]]
    given = spark.createDataFrame([(i if i else None, v, 1.0, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, n double, x string")
    found = {r.vec_id: r for r in whitening.whiten(given).collect()}
    assert set(found) == set(range(4, 15))
    assert found[4].z == [] and found[6].z == [0.0] and found[6].identity_error == 1.0 and found[12].n == 1
    assert found[8].n == 3 and found[8].z == found[9].z and len(found[10].z) == 2 and found[10].identity_error < 1e-9
    assert list(found[11].x) == [64, -1] and found[13].deviation is None
    assert whitening.whiten(given.limit(0)).count() == 0


def slow_links(rows, threshold=0.9):
    good = [(i, k, np.array(v, float)) for i, (k, v) in enumerate(rows) if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    parent, n = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, _, a), (j, _, b) in itertools.combinations(good, 2):
        if len(a) == len(b) and (a / np.linalg.norm(a)) @ (b / np.linalg.norm(b)) >= threshold:
            n[i], n[j] = n[i] + 1, n[j] + 1
            parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        least[root(i)] += [k] if k is not None else []
    return sorted(((k, n[i], min(least[root(i)], default=None)) for i, (k, _) in enumerate(rows)), key=str)


def links_of(spark, rows):
    given = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<float>, id string, v int")
    found = pivots.linked_vectors(given).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in found), key=str)


def near(rng, v, cosine):
    u = rng.normal(size=len(v))
    u -= (u @ v) * v
    return cosine * v + np.sqrt(1 - cosine**2) * u / np.linalg.norm(u)


def single(v):
    return np.array(v, np.float32).tolist()


@pytest.mark.parametrize("d", [2, 8, 64, 300])
def test_op13_recall(spark, d):
    """Pairs, chains and copies at cosines near the threshold among vectors that have nothing to do with them."""
    rng = np.random.default_rng(d)
    unit = lambda: (lambda v: v / np.linalg.norm(v))(rng.normal(size=d))
    made = [unit() for _ in range(300)]
    for c in (0.905, 0.93, 0.96, 0.99):
        for v in made[:60]:
            made.append(near(rng, v, c))
    rows = [(i, single(v * rng.uniform(0.1, 9))) for i, v in enumerate(made)]
    want, found = slow_links(rows), links_of(spark, rows)
    assert all(a[1] <= b[1] for a, b in zip(found, want, strict=True))
    assert sum(r[1] for r in found) >= 0.97 * sum(r[1] for r in want)


def test_op13_large_groups_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 32)
    monkeypatch.setattr(pivots, "STRIP", 7)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)
    rows = [(i, single(near(rng, centre, 0.99))) for i in range(200)] + [(500 + i, single(centre * 3)) for i in range(50)] + [(900 + i, single(rng.normal(size=64))) for i in range(100)]
    rng.shuffle(rows)
    assert links_of(spark, rows) == slow_links(rows)


def test_op13_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, None), (3, [0.0, 0.0]), (4, [0.0, -0.0]), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0]), (10, [2.0]), (11, [-1.0]), (12, [1.0, 0.0]), (None, [1.0, 0.0]), (12, [1.0, 0.0]), (13, [5.0, 0.1])]
    rows += [(12, [0.0, 7.0]), (14, [-0.0, 1e-30]), (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.1]), (15, [3e38, 3e38, 0.0, 0.0]), (16, [1e-38, 1e-38, 0.0, 0.0])]
    assert links_of(spark, rows) == slow_links(rows)
    assert links_of(spark, []) == []
