"""Every stage of the corpus pipeline against a brute-force version, on its own input."""

import random

import corpus_pipeline
from test_dedup import brute_hits, brute_join, brute_lines
from test_queries import check_packed

from tidemark.llm.quality import quality_scores


def planted(rng):
    words = ["the", "cat", "sat", "on", "a", "mat", "and", "then", "it", "was", "gone", "again", "while", "nobody", "looked"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) * (rng.random() < 0.5) for _ in range(n))
    item = text(30)
    rows, labels = [], []
    for i in range(160):
        good = i % 4 != 0
        body = text(rng.randint(40, 80))
        rows.append((i, body if good else body.replace(" ", "%%% ")))
        if i < 120:
            labels.append((i, int(good), 0))
    passage = "\n".join(text(12) for _ in range(4))
    rows += [(200 + i, f"{text(20)}\n{passage}\n{text(20)}") for i in range(4)]
    rows += [(300, passage), (301, passage + "\n" + passage)]
    rows += [(400 + i, rows[1][1] + f" end{i}") for i in range(5)]
    rows += [(500, text(20) + " " + item.upper() + " " + text(20)), (501, text(10) + " " + " ".join(item.split()[:9]) + " " + text(10))]
    rows += [(600, None), (601, ""), (None, text(40)), (602, rows[1][1]), (1, rows[1][1])]
    return rows, labels, [(1, item), (2, None)]


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_stages(spark, tmp_path):
    rows, labels, items = planted(random.Random(21))
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    sf = str(tmp_path)
    tables = {
        "documents": (full, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (items, "item_id long, text string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/{name}.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]
    before = rows
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf)
        made.write.parquet(f"{sf}/{name}")
        after = spark.read.parquet(f"{sf}/{name}")
        if name != "packing":
            assert after.columns == docs.columns
            got = pairs(after)
        if name == "quality":
            wanted = {(r.doc_id, r.score >= 0.7) for r in quality_scores(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
            assert got == sorted(((i, t) for i, t in before if (i, True) in wanted), key=repr)
            assert {i for i, _ in got if i is not None and 120 <= i < 160} == {i for i in range(120, 160) if i % 4}
        elif name == "line_dedup":
            left = brute_lines(before)
            kept = [(i, left[i, t][0]) for i, t in before if not left[i, t][2] or left[i, t][0].strip()]
            assert got == sorted(kept, key=repr)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after.collect())
        elif name == "near_duplicates":
            groups = {}
            for (i, n, root), (_, t) in zip(brute_join(before), before, strict=True):
                groups.setdefault((root, i if n == 0 else None, t if n == 0 else None), []).append((i, t))
            kept = [g for (_, _, _), g in groups.items()]
            assert len(got) == sum(len(g) if not (g[0][1] or "").split() else 1 for g in kept)
            for g in kept:
                if (g[0][1] or "").split():
                    assert min((d for d in g), key=lambda d: (d[0] is None, d[0] or 0))[0] in {i for i, t in got if (i, t) in g}
        elif name == "decontamination":
            clean = [(i, t) for (i, t), h in zip(before, brute_hits(before, items), strict=True) if not h[2]]
            assert got == sorted(clean, key=repr) and 500 not in dict(got) and len(got) < len(before)
        else:
            check_packed(after.collect(), dict(before))
            again = corpus_pipeline.run(spark, sf)
            columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            assert sorted(map(tuple, again.select(columns).collect()), key=repr) == sorted(map(tuple, after.select(columns).collect()), key=repr)
        if name != "packing":
            docs, before = after, got


def test_passages_inside_one_line_go(spark, docs):
    passage = "The cat sat down. Then it slept. Nobody looked."
    rows = [(1, f"Early on. {passage}", 0), (2, f"Later on. {passage} It woke.", 0)]
    left = corpus_pipeline.line_dedup(spark, docs(rows, "doc_id long, text string, n_chars long"), "")
    assert sorted(map(tuple, left.collect())) == [(1, rows[0][1], 57), (2, "Later on. It woke.", 18)]


def test_near_copies_between_the_thresholds_go(spark, docs):
    a = [f"w{i}" for i in range(100)]
    b = [f"x{i}" if i in (30, 60) else w for i, w in enumerate(a)]  # 86/106 on five words, 89/105 on four
    left = corpus_pipeline.near_duplicates(spark, docs([(1, " ".join(a)), (2, " ".join(b)), (3, "other words")]), "")
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]
