"""Personal data, secrets, licenses and quality."""

import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import secrets
from tidemark.llm.licenses import NOTICES, license_scan
from tidemark.llm.pii import KINDS, personal_data
from tidemark.llm.quality import accepted, fit, labelled, quality_scores, statistics, tree_rules
from tidemark.llm.secrets import secret_spans

# --- personal data


def luhn(digits):
    worth = [int(c) * (2 if at % 2 else 1) for at, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in worth) % 10 == 0


def base_pii(text):
    text, out = text or "", []
    out += [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def test_base_spans_against_brute_force(clashing, odd):
    rng = random.Random(4)
    pool = "aZ09.@+-_% ()1234 5678\n😀é"
    rows = odd + [(100 + i, "".join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(800)]
    fixed = [
        "a@b.c_d@e.f g@h", "1.2.3.4.5.6.7.8", "1.2.3.4.5", "0000.0.0.001", "4111 1111 1111 1111", "1" * 20_000,
        "4111111111111111 5500005555555559", "+1 (017) 555-7713 +1 (017) 555-7713", "😀 x@y.zz 1.2.3.255", "a" * 20_000 + "@b.c",
    ]
    rows += [(2000 + i, t) for i, t in enumerate(fixed)]
    want = {}
    for i, t in rows:
        want.setdefault(i, set()).add(tuple(base_pii(t)))
    got = personal_data(clashing(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple((s.kind, s.start, s.end) for s in r.base) in want[r.doc_id]


def test_contexts_discover_identifiers(docs):
    rng = random.Random(6)
    known = [(i, f"you can reach me at user{i}{rng.randrange(99)}1234@mail{i}.org today") for i in range(12)]
    unseen = [(50, "you can reach me at user_4711_home and nowhere else"), (51, "it was in the year 20145 or so")]
    got = {r.doc_id: r for r in personal_data(docs(known + unseen)).collect()}
    text = unseen[0][1]
    assert [(s.kind, text[s.start : s.end]) for s in got[50].added] == [(KINDS.index("context"), "user_4711_home")]
    assert not got[51].added and all(not got[i].added for i, _ in known)


def test_seeds_of_any_form_support_a_context(docs):
    emails = [f"you can reach {n}@mail.org." for n in ("anna", "ben", "eve", "carl.19", "dora")]
    cards = ["4111 1111 1111 1111", "5500 0055 5555 5559", "4012 8888 8888 1881", "3782 822463 10005", "6011 1111 1111 1117"]
    phones = [f"please call now {p}." for p in ("+1 (017) 555-7713", "10.20.30.40")]
    known = emails + [f"paid with card {c} then" for c in cards] + phones
    unseen = ["you can reach user_4711_home. Or not", "paid with card 9999-8888x.", "please call now 20145"]
    rows = list(enumerate(known + unseen))
    got = {r.doc_id: r for r in personal_data(docs(rows)).collect()}
    added = [[t[s.start : s.end] for s in got[i].added] for i, t in rows]
    assert added == [[] for _ in known] + [["user_4711_home"], ["9999-8888x"], []]


def test_patterns_come_in_rounds(docs):
    # "staff badge _" is learned from emails; its badges then carry "_ on duty", which no seed stands before.
    emails = [f"staff badge {n}@mail.org in hall {at}" for at, n in enumerate(("anna", "ben", "eve", "carl", "dora", "finn", "gus", "hal", "ida", "jo"))]
    emails += [f"again staff badge {n}@mail.net was on duty" for n in ("kim", "lea", "max", "noa", "oto", "pia", "qi")]
    carried = [f"staff badge kx-{4000 + i}-q on duty" for i in range(2)]
    seeds_of_duty = [f"seen {n}@post.org on duty" for n in ("ria", "sam", "tom", "uma", "val", "wes", "xia", "yan")]
    rows = list(enumerate(emails + carried + seeds_of_duty + ["then zz-9876-w on duty", "code 20145 in room"]))
    first = {r.doc_id: len(r.added) for r in personal_data(docs(rows), rounds=1).collect()}
    assert first[len(rows) - 2] == 0 and sum(first.values()) == 2
    got = {r.doc_id: r for r in personal_data(docs(rows)).collect()}
    added = {i: [t[s.start : s.end] for s in got[i].added] for i, t in rows}
    assert [added[i] for i, t in rows if t in carried] == [["kx-4000-q"], ["kx-4001-q"]]
    assert added[len(rows) - 2] == ["zz-9876-w"] and added[len(rows) - 1] == []


def test_planted_identifiers(docs):
    """Precision and recall over planted contexts on either side, among numbers that are no identifiers."""
    rng = random.Random(9)
    words = "the of and to in a is was with from some other year people house water".split()
    prose = lambda n: " ".join(rng.choices(words, k=n))
    frames = ["reach me at {} {}", "my contact {} is", "{1} {0} belongs to {1}", "member {} joined {}", "account number: {} {}"]
    rows, want = [], {}
    for i in range(1200):
        frame, unseen = frames[i % len(frames)], i // 5 % 10 == 9
        value = f"{rng.choice('abc')}x{rng.randrange(10**5, 10**6)}-z" if unseen else f"{rng.choice(words)}{i}@mail{rng.randrange(9)}.org"
        text = f"{prose(20)} {frame.format(value, prose(3))} {prose(20)}"
        rows.append((i, text))
        if unseen:
            want[i] = [value]
    # As in real texts, plain numbers are several times as common as identifiers.
    rows += [(5000 + i, " ".join(f"{prose(5)} {rng.randrange(1000, 9999)}" for _ in range(10)) + f" {prose(5)}") for i in range(600)]
    texts = dict(rows)
    got = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.added] for r in personal_data(docs(rows)).collect() if r.added}
    right = sum(got.get(i) == v for i, v in want.items())
    assert len(want) == 120 and right >= 0.9 * len(want) and right >= 0.9 * len(got)


def test_a_pattern_needs_several_texts(docs):
    one = " ".join(f"call me on {n}@mail.org today." for n in ("anna", "ben", "eve", "carl", "dora", "finn"))
    (row,) = personal_data(docs([(1, one + " call me on 4711-x today.")])).collect()
    assert len(row.base) == 6 and not row.added


def test_no_personal_data(docs):
    assert personal_data(docs([])).count() == 0
    assert [(r.base, r.added) for r in personal_data(docs([(1, "nothing here"), (None, None)])).collect()] == [([], [])] * 2


# --- secrets


def base_secrets(text):
    text, out = text or "", []
    assign = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def random_string(rng, letters, n):
    return "".join(rng.choices(letters, k=n))


def test_secrets_against_brute_force(clashing, odd):
    rng = random.Random(8)
    rows = list(odd)
    for i in range(400):
        parts = rng.choices(
            ["é ", "token=", "API_KEY : '", "password", "😀", "\n", "secret\"='", random_string(rng, "0123456789abcdef", rng.randint(25, 45)),
             "AKIA" + random_string(rng, string.ascii_uppercase, rng.randint(5, 20)), "abc-def.g", " = "], k=rng.randint(1, 8))
        rows.append((100 + i, "".join(parts)))
    want = {}
    for i, t in rows:
        want.setdefault(i, set()).add(tuple(base_secrets(t)))
    got = secret_spans(clashing(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple((s.start, s.kind, s.end) for s in r.base) in want[r.doc_id]


def test_models_tell_random_from_ordinary(docs):
    rng = random.Random(10)
    words = ["configuration", "manager", "instance", "report", "version", "account", "number", "final", "the", "of", "Quick", "JSON"]
    ordinary = [(i, " ".join(rng.choices(words, k=60)) + f" {rng.choice(words)}_{rng.choice(words)}_{rng.randrange(99)}") for i in range(400)]
    labelled_rows = [(100 + i, f'token = "{random_string(rng, "0123456789abcdef", 40)}"') for i in range(30)]
    key = random_string(rng, string.ascii_lowercase + string.digits, 36)
    got = {r.doc_id: r for r in secret_spans(docs(ordinary + labelled_rows + [(500, f"é see {key} there")])).collect()}
    assert [(s.start, s.end) for s in got[500].added] == [(6, 6 + len(key))]
    assert not any(got[i].added for i, _ in ordinary)


def test_runs_of_any_length_and_alphabet(docs):
    rng = random.Random(11)
    words = ["configuration", "manager", "instance", "report", "version", "account", "number", "final", "the", "of", "Quick", "JSON", "2024"]
    # Random strings are a three-hundredth of the letters: the models take them to be rare.
    ordinary = [(i, " ".join(rng.choices(words, k=600)) + f" {rng.randrange(10**8)}") for i in range(300)]
    samples = [(1000 + i, f'token = "{random_string(rng, "0123456789abcdef", 40)}"') for i in range(30)]
    alphabets = (string.ascii_letters + string.digits, string.ascii_letters, string.ascii_lowercase + string.digits)
    planted = [(2000 + i, f"ü the {random_string(rng, rng.choice(alphabets), rng.randint(14, 34))} of") for i in range(200)]
    got = {r.doc_id: [(s.start, s.end) for s in r.added] for r in secret_spans(docs(ordinary + samples + planted)).collect()}
    hit = [got[i] == [(6, len(t) - 3)] for i, t in planted]
    # Shorter ones weigh less: 14 to 17 characters are found mostly, longer ones nearly always.
    assert sum(hit) >= 0.9 * len(planted)
    assert sum(h for h, (_, t) in zip(hit, planted, strict=True) if len(t) >= 27) >= 0.97 * sum(len(t) >= 27 for _, t in planted)
    # Digits alone are ordinary here, and so is every word.
    assert not any(got[i] for i, _ in ordinary)


def test_names_in_email_addresses_are_no_secrets(docs):
    rng = random.Random(13)
    words = ["configuration", "manager", "instance", "report", "version", "account", "number", "final", "the", "of", "Quick", "JSON", "2024"]
    ordinary = [(i, " ".join(rng.choices(words, k=600)) + f" {rng.randrange(10**8)}") for i in range(300)]
    samples = [(1000 + i, f'token = "{random_string(rng, "0123456789abcdef", 40)}"') for i in range(30)]
    a, b, c = (random_string(rng, string.ascii_lowercase + string.digits, 34) for _ in range(3))
    rows = [(2000, f"é {a}.71@mail0.example.com the"), (2001, f"https://user:{b}@db.example.com/of"), (2002, f"the {c}@ of")]
    got = {r.doc_id: [(s.start, s.end) for s in r.added] for r in secret_spans(docs(ordinary + samples + rows)).collect()}
    assert [got[i] for i, _ in rows] == [[], [(13, 47)], [(4, 38)]]


def test_random_runs_against_brute_force():
    rng = np.random.default_rng(12)
    ratios = rng.normal(1.0, 3.0, (secrets.CLASSES, secrets.CLASSES))
    for size in (0, 1, 2, 3, 50, 3000):
        classes = rng.integers(0, 12, size) * rng.integers(0, 2, size)
        want, at = [], 0
        while at < size:
            end = at
            while end < size and classes[end]:
                end += 1
            total = sum(ratios[classes[i], classes[i + 1]] for i in range(at, end - 1))
            if end - at > 2 and total >= max(4.0, 1.2 * (end - at)):
                want.append((at, end))
            at = max(end, at) + 1
        assert secrets.random_runs(classes, ratios, 1.2, 4.0) == want


def test_ratios_are_finite_without_samples(docs):
    none = np.zeros((secrets.CLASSES, secrets.CLASSES))
    assert np.isfinite(secrets.log_ratios(none, none)).all()
    assert secret_spans(docs([])).count() == 0


# --- licenses


def test_phrases_and_places(clashing, odd):
    rows = odd + [
        (100, "Under the MIT-License, the mit license; GNU general public license"),
        (101, "cc\nby and CC BY-NC"),
        (102, "gnu general public gnu general public license"),
        (103, "mit mit license"),
    ]
    got = {r.doc_id: r for r in license_scan(clashing(rows)).collect() if (r.doc_id or 0) >= 100}
    phrases = {i: [(p.place, p.label) for p in r.phrases] for i, r in got.items()}
    assert phrases == {
        100: [(2, "mit"), (5, "mit"), (7, "gpl")], 101: [(0, "cc-by"), (3, "cc-by")], 102: [(3, "gpl")], 103: [(1, "mit")],
    }
    assert got[100].n_words == 11
    assert license_scan(clashing(rows)).count() == len(rows)


def test_blocks_against_brute_force(docs):
    rng = random.Random(12)
    cut = lambda t: set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()))
    rows = []
    for i in range(200):
        ws = rng.choice(NOTICES)[1].split()
        kept = [w for w in ws if rng.random() < 0.85] + rng.choices(["the", "of", "license", "other", "words"], k=rng.randint(0, 6))
        rng.shuffle(kept)
        at = rng.randrange(len(kept) + 1)
        rows.append((i, "intro line\n\n" + " ".join(kept[:at]) + rng.choice(["\n", " ", "\n\n"]) + " ".join(kept[at:]) + "\n\nend"))
    for r in license_scan(docs(rows)).collect():
        lines = rows[r.doc_id][1].split("\n")
        blocks = [line for line in lines if line.strip()]
        blocks += [p for p in re.split(r"\n\n+", rows[r.doc_id][1]) if "\n" in p.strip("\n")]
        want = {label for b in blocks for label, t, _ in NOTICES if 100 * len(cut(b) & cut(t)) >= 80 * len(cut(t))}
        assert {m.label for m in r.matches} == want


def named(spark_docs, text):
    (row,) = license_scan(spark_docs([(1, text)])).collect()
    return sorted({m.label for m in row.matches if m.named})


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["cc-by-nc-sa"]),
        ("Licensed under CC BY 4.0", []),
        ("This work is licensed under the GNU General Public License, version 3.", ["gpl-notice"]),
        ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
        ("Released under the Apache License, Version 2.0", ["apache-2.0"]),
        ("Released under the BSD License", ["bsd"]),
        ("Released under the MIT License.", ["mit-notice"]),
        ("you can redistribute it and/or modify it\nunder the terms of the GNU Lesser General\nPublic License as published", ["lgpl"]),
        ("Permission is hereby granted to any person obtaining a copy of this software and associated documentation files", []),
    ],
)
def test_labels_of_notices(docs, text, labels):
    assert named(docs, text) == labels
    assert named(docs, f"some words before\n\n{text}\n\nand after") == labels


def test_every_notice_names_itself_only(docs):
    got = license_scan(docs([(at, text) for at, (_, text, _) in enumerate(NOTICES)])).collect()
    assert len(got) == len(NOTICES)
    for r in got:
        assert {m.label for m in r.matches if m.named} == {NOTICES[r.doc_id][0]}


def test_no_licenses(docs):
    assert license_scan(docs([])).count() == 0
    assert [(r.n_words, r.phrases, r.matches) for r in license_scan(docs([(1, None)])).collect()] == [(0, [], [])]


# --- quality


def labelled_docs(n=240):
    rng = random.Random(13)
    words = ["the", "cat", "sat", "on", "a", "mat", "and", "then", "it", "was", "gone", "again"]
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        ws = rng.choices(words, k=rng.randint(20, 60))
        rows.append((i, " ".join(ws) if good else "%%% ".join(ws)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark, clashing, odd):
    rows, labels = labelled_docs()
    rows += [(None if i is None else 10_000 + i, t) for i, t in odd]
    label_rows = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = quality_scores(clashing(rows), label_rows).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    import zlib

    known = {i: q for i, q, _ in labels}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    tested = [r for r in got if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in tested) >= 0.95 * len(tested)
    left = accepted(clashing(rows), label_rows)
    assert left.columns == clashing(rows).columns and left.count() == sum(r.predicted for r in got)


def test_held_out_labels_are_not_learned(spark, docs):
    rows, labels = labelled_docs()
    held = quality_scores(docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    flipped = {r.doc_id for r in held.where("held_out").collect()}
    other = [(i, 1 - q if i in flipped else q, t) for i, q, t in labels]
    again = quality_scores(docs(rows), spark.createDataFrame(other, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, held.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (1, 1, 0)], [(0, 0, 0)]])
def test_labels_of_one_kind_give_one_score(spark, docs, labels):
    rows, _ = labelled_docs(12)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert len({r.score for r in quality_scores(docs(rows), table).collect()}) == 1
    assert quality_scores(docs([]), table).count() == 0


def test_rules_are_compiled_as_they_answer(spark, docs):
    rows, labels = labelled_docs()
    measured = statistics(docs(rows))
    model = fit(labelled(measured, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert model.weights
    for r in measured.withColumn("score", model.score()).collect():
        total = model.intercept + sum(
            w for rule, w in model.weights if all((r[t.statistic] <= t.bound) == t.at_most for t in rule)
        )
        assert abs(r.score - 1 / (1 + np.exp(-total))) < 1e-9


def test_paths_of_a_tree():
    described = (
        "DecisionTreeClassificationModel: depth=2\n"
        "  If (feature 0 <= 1.5)\n"
        "   If (feature 2 <= 3.0)\n"
        "    Predict: 0.0\n"
        "   Else (feature 2 > 3.0)\n"
        "    Predict: 1.0\n"
        "  Else (feature 0 > 1.5)\n"
        "   Predict: 1.0\n"
    )
    rules = tree_rules(described)
    assert [len(r) for r in rules] == [1, 2, 2, 1]
    assert {t.at_most for t in rules[3]} == {False}


def test_statistics_of_empty_texts(docs):
    row = statistics(docs([(1, None)])).select(*map(F.col, ["log_chars", "entropy"])).collect()[0]
    assert tuple(row) == (0.0, 0.0)
