"""The embedding join, the filter audit and ranked search against brute force."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import embedding_join as vectors_module
from tidemark.llm.embedding_join import located, near_vectors, reach, space_of, unit
from tidemark.llm.filter_audit import Diagram, adjacent_swaps, audit_of_part, failure_masks, filter_audit
from tidemark.llm.ranked_search import _hopeful, ranked_search
from tidemark.session import setting

WIDE = "vec_id long, embedding array<double>, label int, node long, links long, h1 long, root long, size int, copies long, own boolean, tile int"


# --- embeddings


def brute_vectors(rows, cosine):
    good = [
        bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    links = [[] for _ in rows]
    for length in {len(v) for (_, v), ok in zip(rows, good, strict=True) if ok}:
        at = [i for i, (_, v) in enumerate(rows) if good[i] and len(v) == length]
        units = unit(np.array([rows[i][1] for i in at], dtype=float))
        near = units @ units.T >= cosine
        for a, i in enumerate(at):
            links[i] = [at[b] for b in np.flatnonzero(near[a]) if at[b] != i]
    component = list(range(len(rows)))

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for i, others in enumerate(links):
        for j in others:
            a, b = root(i), root(j)
            component[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for i, (vec_id, _) in enumerate(rows):
        ids[root(i)].append(vec_id)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        known = [v for v in ids[root(i)] if v is not None]
        smallest = min(known, default=None)
        out.append((vec_id, len(links[i]), smallest, vec_id == smallest))
    return sorted(out, key=repr)


def planted(seed=0, dims=24):
    """Lone vectors, copies, a wide clump, chains and scaled copies."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dims) for _ in range(150)]
    centre = rng.normal(size=dims)
    rows += [centre + 0.22 * rng.normal(size=dims) * np.linalg.norm(centre) / math.sqrt(dims) for _ in range(120)]
    chain = rng.normal(size=dims)
    for _ in range(25):
        chain = chain + 0.28 * rng.normal(size=dims) * np.linalg.norm(chain) / math.sqrt(dims)
        rows.append(chain)
    rows += [rows[3]] * 40 + [rows[5] * 7.5, rows[6] * 1e200, rows[7] * 1e-200]
    order = rng.permutation(len(rows))
    return [(int(i * 3), [float(x) for x in rows[at]]) for i, at in enumerate(order)]


@pytest.mark.parametrize(("cell", "sample"), [(8192, 32768), (40, 32768), (40, 70), (10, 40)])
def test_vectors_against_brute_force(spark, monkeypatch, cell, sample):
    monkeypatch.setattr(vectors_module, "LEAST_SAMPLED", 8)
    rows = planted() + [
        (9001, None), (9002, []), (9003, [0.0] * 24), (9004, [None, *[1.0] * 23]), (9005, [float("nan"), *[1.0] * 23]),
        (9006, [float("inf"), *[1.0] * 23]), (9007, [1.0, 2.0, 3.0]), (9008, [2.0, 4.0, 6.1]), (9009, [-1.0, -2.0, -3.0]),
        (9010, [0.5]), (9011, [-0.5]), (9012, [2.5]), (None, [1.0, 2.0, 3.0]), (None, None), (9013, [4.0, 1.0]), (9013, [4.0, 1.0]),
        (None, [3.0, -7.0, 1.0, 1.0]), (None, [3.0, -7.0, 1.0, 1.1]),
    ]
    table = spark.createDataFrame([(a, b, *[None] * 9) for a, b in rows], WIDE)
    got = near_vectors(table, 0.95, axes=6, cell=cell, sample=sample).collect()
    want = brute_vectors(rows, 0.95)
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == want
    assert max(n for _, n, _, _ in want) > 40


def test_cells_are_cut_and_dealt():
    sample = unit(np.random.default_rng(1).normal(size=(4000, 32)))
    space = space_of(sample, 400_000, 0.95, axes=8, cell=8192)
    assert all(len(b.planes) > 3 and b.tiles.max() >= 1 for b in space.blocks)
    assert abs(sum(b.budget for b in space.blocks) - 0.1) < 1e-6
    tight = unit(1 + 1e-3 * np.random.default_rng(2).normal(size=(4000, 32)))
    assert max(b.tiles.max() for b in space_of(tight, 400_000, 0.95, axes=8, cell=8192).blocks) >= 20


def test_vectors_within_reach_meet_once():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(600, 4)).astype(np.float32)
    points[300:] = points[:300] + rng.normal(size=(300, 4)).astype(np.float32) * 0.02
    sample = unit(rng.normal(size=(2000, 4)))
    block = space_of(sample, 200_000, 0.99, axes=4, cell=8192).blocks[0]
    row, cell, own = located(block, points)
    assert len(block.planes) > 3 and Counter(row[own].tolist()) == Counter(range(600))
    home = dict(zip(row[own].tolist(), cell[own].tolist(), strict=True))
    there = set(zip(row.tolist(), cell.tolist(), strict=True))
    gaps = np.linalg.norm(points[:, None] - points[None], axis=2)
    for a, b in zip(*np.nonzero(gaps <= reach(block.budget) - 1e-4), strict=True):
        assert (int(a), min(home[a], home[b])) in there


@pytest.mark.parametrize(("dense", "pairs"), [(0.0, 1 << 16), (0.1, 50), (2.0, 1 << 16)])
def test_chunks_against_brute_force(monkeypatch, dense, pairs):
    """Any split into chunks, caps and pieces counts each pair once, whether pairs are decided singly or as a whole."""
    monkeypatch.setattr(vectors_module, "_DENSE", dense)
    monkeypatch.setattr(vectors_module, "_PAIRS", pairs)
    monkeypatch.setattr(vectors_module, "_ABOUT", 12)
    monkeypatch.setattr(vectors_module, "_CAP", 5)
    monkeypatch.setattr(vectors_module, "_OTHERS", 30)
    rng = np.random.default_rng(4)
    table = np.array([v for _, v in planted(seed=6) if max(map(abs, v)) < 1e100 and max(map(abs, v)) > 1e-100], dtype=np.float32)
    weight = rng.integers(1, 4, len(table))
    caps = vectors_module.caps_of(unit(table[:200].astype(float)), len(table), 0.95, 16, 0)
    assert len(caps.centres) > 10
    points = vectors_module.turned(unit(table.astype(float)), caps.space.axes)
    centre = vectors_module.nearest(points, caps.centres)
    where = rng.integers(0, 3, len(table))
    chunks = []
    for number in range(3):
        rows = np.flatnonzero(where == number)
        order, close = vectors_module.by_centre(caps, points[rows], centre[rows])
        rows = rows[order]
        chunks.append(vectors_module.chunk_of(caps, 6, rows, weight[rows], centre[rows], close, table[rows]))
    near = unit(table.astype(float)) @ unit(table.astype(float)).T >= 0.95
    np.fill_diagonal(near, False)
    links, together = np.zeros(len(table), dtype=int), np.arange(len(table))
    for a, b in [(0, None), (1, None), (2, None), (0, 1), (0, 2), (2, 1)]:
        other = None if b is None else chunks[b]
        found, roots = vectors_module.compared(caps, chunks[a], other, 0.95)
        nodes = np.concatenate([chunks[a].node, chunks[b].node if other else []]).astype(int)
        np.add.at(links, nodes, found)
        vectors_module._hang_together(together, nodes, nodes[roots])
    assert links.tolist() == (near @ weight).tolist() and near.sum() > 2000
    want = np.arange(len(table))
    vectors_module._hang_together(want, *np.nonzero(near))
    assert together.tolist() == want.tolist()


def test_vectors_are_not_copied_to_the_cells_they_reach(spark):
    """What is shuffled, written and read grows with the vectors, not with the cells that they reach."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=32)]) for i in range(3000)] + [(3000 + i, [1.0 + i % 7 / 50, *[1.0] * 31]) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    store = spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        nothing = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
        stages = store.stageList(None, False, False, nothing, spark.sparkContext._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = shuffled()
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        got = near_vectors(table, cell=256).collect()
    assert shuffled() - before < 6 * 3000 * 32 * 8
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=repr) == brute_vectors(rows, 0.95)


def test_no_vectors(spark):
    assert near_vectors(spark.createDataFrame([], WIDE)).collect() == []
    (row,) = near_vectors(spark.createDataFrame([(4, None)], "vec_id long, embedding array<float>")).collect()
    assert tuple(row) == (4, 0, 4, True)
    with pytest.raises(ValueError):
        near_vectors(spark.createDataFrame([], WIDE), cosine=0)


# --- filter audit


def brute_audit(masks, names):
    fails = [(m, *w) for m, w in masks.items()]
    out = {}
    for order in itertools.permutations(range(len(names))):
        for step, f in enumerate(order, 1):
            before = sum(1 << g for g in order[: step - 1])
            here = [w for w in fails if w[0] >> f & 1 and not w[0] & before]
            out["".join(names[g] for g in order), step] = [
                names[f],
                sum(w[1] for w in fails if not w[0] & (before | 1 << f)),
                sum(w[1] for w in here),
                sum(w[1] for w in fails if w[0] >> f & 1 and w[0] & before),
                sum(w[1] for w in fails if w[0] == 1 << f),
                sum(w[2] for w in here),
                sum(w[3] for w in here),
            ]
    shapley = Counter()
    for v in out.values():
        shapley[v[0]] += v[2]
    return {k: tuple([*v, shapley[v[0]]]) for k, v in out.items()}


@pytest.mark.parametrize("filters", ["A", "AB", "QRS", "ABCD", "ABCDE"])
def test_audit_against_brute_force(filters):
    rng = random.Random(len(filters))
    for share in (0.0, 0.3, 1.0):
        masks = {m: (rng.randint(1, 4), rng.randint(0, 2), 1) for m in range(1 << len(filters)) if rng.random() < share}
        rows = list(audit_of_part(masks, filters))
        assert {(r[0], r[1]): tuple(r[2:]) for r in rows} == brute_audit(masks, filters)
        assert len(rows) == math.factorial(len(filters)) * len(filters)


def test_swaps_reach_every_order_and_keep_the_diagram():
    for n in range(1, 6):
        order = list(range(n))
        seen = {tuple(order)}
        for at in adjacent_swaps(n):
            order[at], order[at + 1] = order[at + 1], order[at]
            seen.add(tuple(order))
        assert len(seen) == math.factorial(n) == 1 + sum(1 for _ in adjacent_swaps(n))
    masks = {m: (m + 1, 0, 0) for m in range(0, 32, 3)}
    swapped = Diagram(masks, 5)
    for at in (0, 3, 1, 2, 3, 0):
        swapped.swap(at)
        assert swapped.weights[swapped.root][0] == sum(w[0] for w in masks.values())
        reached = {n for level in swapped.levels for sides in level.values() for n in sides}
        assert reached - {0} <= set(swapped.weights)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_masks(rows, labels):
    masks = defaultdict(lambda: [0, 0, 0])
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    smallest = {}
    for doc_id, text, _ in rows:
        key = (doc_id is None, doc_id or 0)
        smallest[text or ""] = min(smallest.get(text or "", key), key)
    for doc_id, text, lang in rows:
        t, ws = text or "", words_of(text)
        mask = (
            (len(ws) < 100) + 2 * (100 * len(set(ws)) < 80 * len(ws)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
            + 8 * bool(re.search(r"[#$%&*|]", t)) + 16 * ((doc_id is None, doc_id or 0) > smallest[t])
        )
        entry = masks[lang or "", mask]
        entry[0] += 1
        entry[1] += doc_id in good
        entry[2] += doc_id in toxic
    return {k: tuple(v) for k, v in masks.items()}


def test_masks_and_audit_of_odd_rows(spark, odd):
    rng = random.Random(5)
    pool = ["word", "Word", "CAPS", "a$b", "ü", "x|y", *(f"w{i}" for i in range(400))]
    rows = [(i, t, rng.choice(["en", "de", None, ""])) for i, t in odd]
    rows += [(100 + i, " ".join(rng.choices(pool, k=rng.choice([0, 50, 150, 300]))), rng.choice(["en", "fr"])) for i in range(60)]
    rows += [(200 + i, rows[-1][1], "en") for i in range(30)] + [(50, rows[-1][1], "fr"), (50, rows[-1][1], "de"), (None, rows[-1][1], "xx")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(90, 240) if i % 2] + [(101, 1, 1), (101, 0, 0), (None, 1, 1)]
    schema = "doc_id long, text string, lang string, part string, mask int, digest string, words string, n long, good int, quality int, toxic int"
    docs = spark.createDataFrame([(*r, *[None] * 8) for r in rows], schema)
    known = spark.createDataFrame([(*x, None) for x in labels], "doc_id long, quality int, toxic int, good long")
    want = brute_masks(rows, labels)
    masks = failure_masks(docs, known)
    assert {(r.part, r["mask"]): (r.n, r.good, r.toxic) for r in masks.collect()} == want
    by_part = defaultdict(dict)
    for (part, mask), w in want.items():
        by_part[part][mask] = w
    got = defaultdict(dict)
    for r in filter_audit(masks, "ABCDE").collect():
        got[r.part][r.filter_order, r.step] = tuple(r)[3:]
    assert got == {part: brute_audit(m, "ABCDE") for part, m in by_part.items()}


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(failure_masks(docs, labels), "ABCDE").collect() == []
    for bad in ("", "AA", "ABCDEFGHI"):
        with pytest.raises(ValueError):
            filter_audit(failure_masks(docs, labels), bad)


# --- ranked search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_search(rows, items, best=10):
    held = [(doc_id, Counter(terms_of(text))) for doc_id, text in rows]
    held = [(doc_id, c) for doc_id, c in held if c]
    n, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    queries = defaultdict(set)
    for item, text in items:
        queries[item] |= set(terms_of(text))
    out = set()
    for item, asked in queries.items():
        scored = []
        for doc_id, c in held:
            m = 100 - 90 + (90 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in asked if c[t]
            )
            if score:
                scored.append((-score, doc_id is None, doc_id or 0))
        out |= {(item, rank, None if no else d, -s) for rank, (s, no, d) in enumerate(sorted(scored)[:best], 1)}
    return out


@pytest.mark.parametrize(("owners", "bundle"), [(1, 256), (4, 256), (3, 2)])
def test_search_against_brute_force(spark, odd, owners, bundle):
    rng = random.Random(9)
    pool = [f"t{min(int(rng.expovariate(0.04)), 90)}" for _ in range(300)] + ["Ärger", "ärger", "LINE", "quick-brown"]
    rows = [*odd, *((100 + i, " ".join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(150))]
    rows += [(99 - i, rows[-1][1]) for i in range(15)] + [(77, "t1 t2"), (77, "t1 t2")]
    items = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "nowhere"), (3, "t5 quick"), (None, "t7 word"), (53, "word one fox the")]
    docs = spark.createDataFrame([(a, b, *[None] * 6) for a, b in rows], "doc_id long, text string, slice long, term string, rank int, score long, bundle int, n_docs long")
    asked = spark.createDataFrame([(a, b, None, None) for a, b in items], "item_id long, text string, weight int, place int")
    got = ranked_search(docs, asked, owners=owners, bundle=bundle).collect()
    assert {tuple(r) for r in got} == brute_search(rows, items) and len(got) == len({(r.item_id, r.rank) for r in got})


def test_search_over_many_slices(spark, monkeypatch):
    from tidemark.llm import ranked_search as module

    monkeypatch.setattr(module, "SLICE_ROWS", 13)
    rng = random.Random(2)
    rows = [(i, " ".join(f"t{int(rng.expovariate(0.2))}" for _ in range(rng.randint(0, 40)))) for i in range(200)]
    items = [(i, f"t{i} t{i + 5} t{2 * i} t0 t1") for i in range(9)]
    docs, asked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {tuple(r) for r in ranked_search(docs, asked, best=3).collect()} == brute_search(rows, items, 3)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search(none, asked).collect() == []
    assert ranked_search(some, asked.where("item_id = 0")).collect() == []
    assert [tuple(r)[:3] for r in ranked_search(some, asked).collect()] == [(1, 1, 1)]


def test_only_hopeless_scores_are_left_behind():
    scores = np.array([[0, 5, 9, 7], [0, 0, 0, 2]])
    assert _hopeful(scores, np.array([2, 0]), 2).tolist() == [[False, True, True, True], [False, False, False, True]]
    assert _hopeful(scores, np.array([1, 0]), 2).tolist()[0] == [False, False, True, True]
    assert _hopeful(scores, np.array([0, 0]), 4).tolist()[0] == [False, True, True, True]
