"""Exact and line deduplication, the n-gram join and decontamination against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import ngram_join as ngrams
from tidemark.llm.decontaminate import contamination, fingerprints, hit_words, uncontaminated, words
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.ngram_join import components, ngram_join, one_of_each

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ordered(rows):
    return sorted(rows, key=repr)


# --- exact deduplication


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_exact(rows, got):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[hashlib.sha256(normal(text).encode()).hexdigest()].append(doc_id)
    want = []
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        want += [(i, min(known) if known else None, len(ids), digest) for i in ids]
    assert ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(want)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}


def test_exact_dedup_of_odd_rows(spark, clashing, odd):
    rows = odd + [(20, "a  b"), (21, "a\tb"), (22, "a b "), (23, "a b")]
    path = clashing(rows).inputFiles()[0].rsplit("/", 1)[0]
    check_exact(rows, exact_dedup(spark, path).collect())


def test_state_goes_on_with_new_files(spark, tmp_path):
    path, state, updates = (f"{tmp_path}/{n}" for n in ("docs", "state", "updates"))
    first, second = [(5, "a b"), (6, "c")], [(2, "a  b"), (9, "c"), (8, "new")]
    for number, rows in enumerate((first, second)):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
        got = exact_dedup(spark, path, state, updates, files_per_batch=1)
        check_exact(first + second if number else first, got.collect())


def test_exact_dedup_of_one_file_and_of_none(spark, tmp_path, docs):
    spark.createDataFrame([(1, "x"), (2, "x")], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/one")
    (file,) = tmp_path.glob("one/*.parquet")
    check_exact([(1, "x"), (2, "x")], exact_dedup(spark, str(file)).collect())
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none")
    assert exact_dedup(spark, f"{tmp_path}/none").count() == 0


def test_texts_of_one_digest_are_told_apart(spark, docs, monkeypatch):
    from tidemark.llm import exact_dedup as module

    monkeypatch.setattr(module, "digest", lambda text: F.unhex(F.sha2(F.substring(text, 1, 1), 256)))
    path = docs([(1, "ab"), (2, "ac"), (3, "ab"), (4, "b")]).inputFiles()[0].rsplit("/", 1)[0]
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(spark, path).collect()}
    assert got == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False), 4: (4, 1, True)}


# --- line deduplication


def brute_lines(rows, size=3):
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        if text is None:
            out[doc_id, text] = (None, 0, 0)
            continue
        lines = text.split("\n")
        covered = set()
        for at in range(len(lines) - size + 1):
            window = tuple(lines[at : at + size])
            if not "".join(window).strip(" "):
                continue
            if window in seen:
                covered.update(range(at, at + size))
            seen.add(window)
        left = [line for at, line in enumerate(lines) if at not in covered]
        out[doc_id, text] = ("\n".join(left), len(lines), len(covered))
    return out


def test_lines_against_brute_force(clashing, odd):
    rng = random.Random(3)
    pool = [f"line {i}" for i in range(6)] + ["", " "]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(60)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(odd)] + [(None, "p\nq\nr"), (200, "p\nq\nr\ns")]
    got = dedup_lines(clashing(rows)).collect()
    want = brute_lines(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r.n_lines, r.n_removed) == want[r.row.doc_id, r.row.text]


def test_repeated_rows_are_one_document(docs):
    got = dedup_lines(docs([(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd")])).collect()
    assert ordered((r.row.doc_id, r.text) for r in got) == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "d")]


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_common_windows_against_brute_force(docs, monkeypatch, share):
    from tidemark.llm import line_dedup

    monkeypatch.setattr(line_dedup, "HOT_SHARE", share)
    rng = random.Random(4)
    rows = [(i, "\n".join(["head", "of", "all", *rng.choices("abcdef", k=rng.randint(0, 9))])) for i in range(80)]
    rows += [(None, "head\nof\nall"), (5, "x\nhead\nof\nall")]
    got = dedup_lines(docs(rows)).collect()
    want = brute_lines(rows)
    assert len(got) == len(rows) and all((r.text, r.n_lines, r.n_removed) == want[r.row.doc_id, r.row.text] for r in got)


def test_passages_inside_lines(docs):
    passage = "It was late. Was it? Nobody knew!  All went home."
    rows = [
        (1, f"First of all. {passage} Then came rain."),
        (2, f"Another start. {passage}"),
        (3, f"One line.\n{passage}\nAnd more. {passage} End\n"),
        (4, "Pi is 3.14 or so. Not at 3.15. " * 2 + "Was it? Nobody knew!"),
    ]
    got = {r.row.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(docs(rows), sentences=True).collect()}
    assert got == {
        1: (rows[0][1], 6, 0), 2: ("Another start. ", 5, 4), 3: ("One line.\nAnd more. End\n", 12, 8), 4: (rows[3][1], 6, 0),
    }


def test_lines_of_no_documents(docs):
    assert dedup_lines(docs([])).count() == 0


# --- n-gram join


def shingles(text, n=4):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    return frozenset(tuple(ws[i : i + n]) for i in range(max(len(ws) - n + 1, min(len(ws), 1))))


def brute_join(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    return [
        (d, len(s), d if not s else min(ids[find(i)], default=None)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def near_copies(rng, n, length, most):
    base = [f"w{i}" for i in range(length)]
    for _ in range(n):
        ws = list(base)
        for _ in range(rng.randint(0, most)):
            ws[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        yield " ".join(ws)


@pytest.mark.parametrize("boundary", [None, 0, 128])
def test_join_against_brute_force(clashing, odd, monkeypatch, boundary):
    if boundary is not None:
        monkeypatch.setattr(ngrams, "BOUNDARIES", (boundary,))
    rng = random.Random(5)
    texts = [t for length in (8, 12, 20, 45, 90, 150) for t in near_copies(rng, 25, length, 4)]
    texts += ["A B c d e f", "a b\tC d\ne f", "a b c", "a b c", "A"]
    rows = odd + [(1000 - i, t) for i, t in enumerate(texts)]
    got = ngram_join(clashing(rows)).collect()
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in got) == ordered(brute_join(rows))
    kept = defaultdict(set)
    for r in got:
        if r.n_shingles and r.kept and r.component_id not in (None, 1):  # two texts have the id 1
            kept[r.component_id].add(r.text_hash)
    assert all(len(k) == 1 for k in kept.values())
    assert set(kept) == {r.component_id for r in got if r.n_shingles and r.component_id not in (None, 1)}


def test_threshold_is_met_exactly(docs):
    a = [f"w{i}" for i in range(40)]  # 37 shingles; 34 of 40 in common are 0.85
    rows = [(1, " ".join(a)), (2, " ".join(a[:37] + ["p", "q", "r"])), (3, " ".join(a[:36] + ["s", "t", "u", "v"]))]
    assert ordered((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs(rows)).collect()) == brute_join(rows)
    assert brute_join(rows)[1][2] == 1


def brute_components(texts, n, needed, of):
    sets = [shingles(t, n) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if of * len(a & b) >= needed * len(a | b) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("boundary", [None, 0, 128])
@pytest.mark.parametrize("share", [(80, 100), (60, 100)])
def test_other_thresholds_against_brute_force(docs, monkeypatch, boundary, share):
    if boundary is not None:
        monkeypatch.setattr(ngrams, "BOUNDARIES", (boundary,))
    rng = random.Random(11)
    texts = [t for length in (7, 8, 9, 12, 20, 45, 90, 150) for t in near_copies(rng, 15, length, 4)]
    # Sets of four and of five shingles, 4/5 in common.
    texts += ["p q r s t u v w", "p q r s t u v w x", "only four short words"]
    got = {r.doc_id: r.component_id for r in ngram_join(docs(list(enumerate(texts))), 5, share).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts, 5, *share)
    assert got[len(texts) - 2] == got[len(texts) - 3]


def test_share_must_make_links_meet_twice(docs):
    with pytest.raises(ValueError):
        ngram_join(docs([(1, "a b")]), share=(50, 100))


def test_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 99), (99, 98), (7, 200)], "a long, b long")
    got = dict((r.node, r.root) for r in components(links).collect())
    assert got == {**{i: 0 for i in [*range(61), 200]}, **{i: 98 for i in (98, 99, 100)}}


def test_one_of_each_keeps_columns_and_one_row(clashing, odd):
    left = one_of_each(clashing(odd + [(50, odd[0][1] + " more")]))
    assert left.columns == clashing(odd).columns
    rows = [(r.doc_id, r.text) for r in left.collect()]
    assert rows.count(odd[0]) == 1 and (None, odd[0][1]) not in rows
    assert {(2, None), (3, ""), (None, None), (1, "another text under the same id")} <= set(rows)


def test_join_of_no_documents(docs):
    assert ngram_join(docs([])).count() == 0
    assert one_of_each(docs([])).count() == 0


# --- decontamination


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_hits(rows, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        ws = cut(text)
        n = min(len(ws), window)
        for at in range(len(ws) - n + 1 if ws else 0):
            windows[tuple(ws[at : at + n])].add(item)
    out = []
    for doc_id, text in rows:
        ws, hit, found = cut(text), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(ws) - n + 1):
                if (w := tuple(ws[at : at + n])) in windows:
                    hit.update(range(at, at + n))
                    found |= windows[w]
        out.append((doc_id, len(ws), len(hit), tuple(sorted(found, key=str))))
    return out


def contaminated_rows(rng):
    base = [f"w{rng.randrange(30)}" for _ in range(400)]
    items = [(1, " ".join(base[:25])), (2, " ".join(base[10:40])), (3, "Only Three words"), (4, "one"), (5, None), (6, ""), (2, "again 2 " * 6)]
    rows = []
    for i in range(80):
        ws = [f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 40))]
        at, n = rng.randrange(40), rng.randint(5, 20)
        ws[3:3] = base[at : at + n]
        rows.append((i, (", ".join(ws) + " ONLY three-words").upper() if i % 5 == 0 else " ".join(ws)))
    return rows, items


def test_hits_against_brute_force(spark, clashing, odd):
    rows, items = contaminated_rows(random.Random(7))
    rows += [(100 + i, t) for i, (_, t) in enumerate(odd)] + [(None, rows[0][1]), (rows[0][0], rows[0][1])]
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")
    found = contamination(clashing(rows), benchmark).withColumn("n_hit", hit_words(F.col("hits")))
    got = [(r.doc_id, r.n_words, r.n_hit, tuple(sorted(r.item_ids or [], key=str))) for r in found.collect()]
    assert ordered(got) == ordered(brute_hits(rows, items))
    left = uncontaminated(clashing(rows), benchmark)
    assert left.count() == sum(not h[2] for h in brute_hits(rows, items))
    assert left.columns == clashing(rows).columns


def test_every_shared_window_has_a_common_fingerprint(spark):
    rng = random.Random(9)
    shared = [f"s{rng.randrange(4)}" for _ in range(10)]
    texts = [(i, " ".join([f"a{rng.randrange(4)}" for _ in range(20)] + shared + [f"b{rng.randrange(4)}" for _ in range(20)])) for i in range(8)]
    rows = spark.createDataFrame(texts, "i int, text string").select(fingerprints(words(F.col("text")), 5, 10).alias("f")).collect()
    assert set.intersection(*({x.hash for x in r.f} for r in rows))


def test_nothing_to_find(spark, docs):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:2] for r in contamination(docs([(1, "a b")]), benchmark).collect()] == [(1, 2)]
    assert contamination(docs([]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).count() == 0
