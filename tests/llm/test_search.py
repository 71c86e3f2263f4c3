"""Decontamination, license scan and private data against plain Python."""

import hashlib
import re

import numpy as np
import pytest

from shelfline.llm import decontaminate, licenses, private_data

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


@pytest.fixture(scope="module")
def items(texts):
    long = texts[30][1].split(" ")
    return [(0, " ".join(long[5:40])), (1, "AA, bb!"), (2, None), (3, ""), (10, " ".join(long[20:32])), (10, " ".join(long[20:32])), (11, "not there at all")]


def brute(texts, items, size=10):
    windows = set()
    for item, text in items:
        words = WORD.findall(lower(text))
        n = min(size, len(words))
        windows |= {(item, tuple(words[i : i + n])) for i in range(len(words) - n + 1) if n}
    out = {}
    for doc, text in texts:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for item, window in windows:
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(str(item))
        out[doc] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 30])
def test_decontamination_equals_brute_force(spark, docs, texts, items, block_words):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs, benchmark, block_words=block_words).drop("items").collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute(texts, items)
    clean = decontaminate.clean_documents(docs, benchmark, block_words=block_words)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, v in brute(texts, items).items() if not v[-1]}


def test_decontamination_of_empty_tables(spark, docs, no_docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.decontaminate(no_docs, benchmark).count() == 0
    assert decontaminate.decontaminate(docs, benchmark.limit(0)).where("contaminated").count() == 0


def test_license_scan(spark, no_docs):
    rows = [
        (0, "x\nLicensed under CC BY-NC 4.0.\nAll rights reserved"), (1, "GNU General, Public (License)"), (2, None), (3, ""),
        (4, "nothing\nlicensed under the apache license version 2.0\n"), (4, "cc\nby cc by"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) for r in licenses.scan_licenses(docs).collect()}
    assert got == {
        (0, 2, 3, 8, "cc-by,reserved", "cc-by,cc-by-nc,reserved", 1.0),
        (1, 1, 1, 1, "gpl", "gpl", 1.0),
        (2, 0, None, None, "", "", 0.0), (3, 0, None, None, "", "", 0.0),
        (4, 0, None, None, "", "apache-2.0", 1.0),
        (4, 2, 0, 2, "cc-by", "cc-by", 1.0),
    }
    assert licenses.scan_licenses(no_docs).count() == 0


def test_license_text_across_line_ends(spark):
    filler = " ".join(f"word{i}" for i in range(60))
    scattered = f" {filler} ".join("licensed under cc 4 0 by".split())
    rows = [
        (0, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"),
        (1, f"{filler}\nThis Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. {filler}"),
        (2, f"{filler} Released under\n * the MIT\n * license {filler}"),
        (3, scattered),
        (4, f"{filler} released under the mit license {filler} redistribution and use in source and binary forms with or without modification are permitted"),
        (5, "redistribution and use in source and binary forms with or"), (5, "without modification are permitted"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [(r["doc_id"], r["labels"], r["score"]) for r in licenses.scan_licenses(docs).collect()]
    assert got == [(0, "bsd", 1.0), (1, "mpl-2.0", 1.0), (2, "mit", 1.0), (3, "", 0.0), (4, "bsd,mit", 1.0), (5, "", 0.0), (5, "", 0.0)]


def test_license_windows_equal_brute_force(spark):
    import math
    import random

    rng = random.Random(8)
    parts = [WORD.findall(lower(text)) for _, text in licenses.TEMPLATES]
    rows = []
    for i in range(200):
        words = [rng.choice(["the", "and", "to", "aa", "bb", "license", "of"]) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            piece = [w for w in rng.choice(parts) for w in ([w, "zz"] if rng.random() < 0.15 else [w]) if rng.random() > 0.1]
            words[(at := rng.randint(0, len(words))) : at] = piece
        rows.append((i, "".join(w + rng.choice([" ", "\n", ", "]) for w in words)))
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), phrases={}).collect()}
    for i, text in rows:
        words, best = WORD.findall(text), {}
        for label, part in zip((t[0] for t in licenses.TEMPLATES), parts, strict=True):
            whole, reach = set(part), math.ceil(len(part) / 0.8)
            held = max((len(whole & set(words[k : k + reach])) for k in range(len(words))), default=0)
            if held >= math.ceil(0.8 * len(whole)):
                best[label] = max(best.get(label, 0), held / len(whole))
        assert got[i]["score"] == max(best.values(), default=0.0)
        assert {b["label"] for b in got[i]["blocks"]} == set(best)
        assert set(filter(None, got[i]["labels"].split(","))) <= set(best)
        for b in got[i]["blocks"]:
            held = set(words[b["first_word"] : b["last_word"] + 1])
            assert any(b["containment"] == len(held & set(part)) / len(set(part)) for (label, _), part in zip(licenses.TEMPLATES, parts, strict=True) if label == b["label"])


def test_base_places_equal_brute_force(spark):
    import random

    rng = random.Random(11)
    bits = ["cc", "by", "CC", "General", "public", "license", "all", "rights", "Reserved", "reserved", "x", "é", "cc by", "general public license", "GENERAL Public\nLicense", "All rights reserved"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice([" ", "\n", "-", ", ", "", "  "]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "cc by " * 5000), (3, "cc by"), (None, "all rights reserved cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_words", "'x' as labels", "2 as score").repartition(3)
    got = sorted((tuple(r)[:6] for r in licenses.scan_licenses(docs).drop("labels", "score", "blocks").collect()), key=str)
    wanted = []
    for doc_id, text in rows:
        words = WORD.findall(lower(text))
        places = sorted((k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
        first, last = (places[0][0], places[-1][0]) if places else (None, None)
        wanted.append((doc_id, len(words), len(places), first, last, ",".join(sorted({label for _, label in places}))))
    assert got == sorted(wanted, key=str)


def test_whole_license_texts_are_found(spark):
    """Each text under its label, wrapped anew, with a name and year before it and some words changed; not from half of it."""
    import random

    rng = random.Random(12)
    rows, wanted = [], {}
    for i, (label, text) in enumerate(licenses.WHOLE_TEXTS):
        words = text.split()
        changed = [w for w in words if rng.random() > 0.05]
        rows.append((i, "copyright 1999 somebody\n" + "".join(w + rng.choice([" ", " ", "\n# "]) for w in changed)))
        wanted[i] = label
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(docs, templates=licenses.WHOLE_TEXTS).collect()}
    assert all(label in got[i]["labels"].split(",") for i, label in wanted.items())
    half = [(i, " ".join(text.split()[: len(text.split()) // 3])) for i, (_, text) in enumerate(licenses.WHOLE_TEXTS)]
    found = licenses.scan_licenses(spark.createDataFrame(half, "doc_id long, text string"), templates=licenses.WHOLE_TEXTS)
    assert all(not r["blocks"] for r in found.collect())


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PATTERNS = {"ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def test_base_spans_equal_the_patterns():
    import random

    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b.", "@", "1", "12", "255", "256.", ".", "-", " ", "+", "4539 1488 0343 6467", "x@y.z", "(", "é"]) for _ in range(30))
        got = private_data.base_spans(text)
        assert got["email"] == [m.span() for m in EMAIL.finditer(text)]
        ips = [m.span() for m in re.finditer(PATTERNS["ip"], text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert got["ip"] == ips
        cards = [(m.span(), re.sub("[ -]", "", m.group())) for m in re.finditer(PATTERNS["card"], text)]
        assert got["card"] == [s for s, d in cards if 16 <= len(d) <= 19 and private_data.passes_luhn(d)]
        assert got["phone"] == [m.span() for m in re.finditer(PATTERNS["phone"], text) if 8 <= len(re.findall("[0-9]", m.group())) <= 15]


def test_private_data_spreads_labels_to_what_the_patterns_miss(spark, no_docs):
    rows = [(i, f"write to ann.{i}@mail{i % 9}.example.com or call +1 (555) 010-{1000 + i} about it, from 10.0.{i}.7 today") for i in range(40)]
    rows += [(100, None), (101, ""), (102, "1" * 50_000), (103, "+1 (555)\n010-1234 and +1 (555) 010-1235"), (103, "a@b.cc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = private_data.find_private(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 103}
    assert all((by[i]["n_email"], by[i]["n_ip"], by[i]["n_phone"]) == (1, 1, 1) for i in range(40))
    assert by[100]["spans"] == by[101]["spans"] == "" and by[102]["n_card"] == 0
    first = next(r for r in got if r["doc_id"] == 103 and r["n_phone"])
    # The number broken by a line end is no base match but has the same words as the next one.
    assert first["n_phone"] == 1 and first["n_added"] >= 1 and "phone:" in first["spans"]
    assert private_data.find_private(no_docs).count() == 0


def test_a_word_repeated_often_gets_one_label(spark):
    rows = [(i, f"call +1 (555) 010-{1000 + i} or again +1 (555) 010-{1000 + i} about order 77{i}, order 77{i}") for i in range(40)]
    often = "call +1 (555) 010-7788 now. " + "Then ask for 010-7788 at the desk of the house. " * 50
    rows += [(100, often), (101, often.replace("call +1 (555) 010-7788 now. ", "") + "or +1 (555) 010-7788")]
    got = {r["doc_id"]: r for r in private_data.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows[-2:]:
        spans = {tuple(map(int, s.split(":")[1:])) for s in got[doc]["spans"].split(",") if s.startswith("phone:")}
        missed = [m.span() for m in re.finditer("010-7788", text) if not any(a <= m.start() and m.end() <= b for a, b in spans)]
        assert not missed and got[doc]["n_added"] >= 50


def test_marginals_equal_enumeration_and_do_not_depend_on_neighbours():
    """Trees of nodes with random weights, some labels given: belief propagation is exact on them."""
    from itertools import product

    rng = np.random.default_rng(4)
    labels, features = len(private_data.LABELS), 6
    field = private_data.Field(rng.normal(size=(features, labels)), rng.normal(size=(3, labels, labels)) * 1.5)
    field.pairs += field.pairs.transpose(0, 2, 1)
    graphs = []
    for size in (1, 2, 3, 5, 6):
        edges = [(int(rng.integers(0, i)), i, int(rng.integers(0, 3))) for i in range(1, size)]
        label = np.where(rng.random(size) < 0.25, rng.integers(1, labels, size), 0)
        own = [rng.integers(0, features, int(rng.integers(0, 4))).tolist() for _ in range(size)]
        graphs.append(private_data.Graph([(0, 0)] * size, [0] * size, label, own, np.array(edges, np.int64).reshape(-1, 3)))
    alone = [private_data.marginals(field, g, 400) for g in graphs]
    for g, found in zip(graphs, alone, strict=True):
        total = np.zeros((len(g.features), labels))
        for states in product(range(labels), repeat=len(g.features)):
            if any(known and known != s for known, s in zip(g.label, states, strict=True)):
                continue
            energy = sum(field.unary[f, s] for s, own, known in zip(states, g.features, g.label, strict=True) if not known for f in own)
            energy += sum(field.pairs[k, states[a], states[b]] for a, b, k in g.edges.tolist())
            total[np.arange(len(states)), list(states)] += np.exp(energy)
        assert found == pytest.approx(total / total.sum(axis=1, keepdims=True), abs=2e-3)
    # All texts in one graph: to the last bit the same.
    at = np.cumsum([0, *(len(g.features) for g in graphs)])
    whole = private_data.Graph(
        [(0, 0)] * at[-1], [i for i, g in enumerate(graphs) for _ in g.features], np.concatenate([g.label for g in graphs]),
        [f for g in graphs for f in g.features], np.concatenate([g.edges + [[a, a, 0]] for g, a in zip(graphs, at, strict=False)]),
    )
    assert (private_data.marginals(field, whole, 400) == np.concatenate(alone)).all()


def test_spans_do_not_depend_on_batches(spark, monkeypatch):
    rows = [(i, f"call +1 (555) 010-{1000 + i} or 010-{1000 + i}, mail x{i}@y.org, host 10.0.0.{i}, then 010-{900 + i} " * (1 + i % 3)) for i in range(60)]
    docs = spark.createDataFrame([*rows, (3, rows[3][1]), (None, "a@b.cc 1.2.3.4"), (7000, "1 " * 30_000)], "doc_id long, text string").selectExpr("*", "1 as n_ip", "'x' as spans")
    field = private_data.learn(docs)
    results = []
    for parts, chars in ((1, 1 << 20), (5, 100)):
        monkeypatch.setattr(private_data, "GRAPH_CHARS", chars)
        results.append(sorted((tuple(r) for r in private_data.find_private(docs.repartition(parts), field).collect()), key=str))
    assert results[0] == results[1]
    again = private_data.learn(docs.repartition(4))
    assert np.allclose(field.unary, again.unary) and np.allclose(field.pairs, again.pairs)
    for doc_id, *counts, digest, spans, added in results[0]:
        if doc_id is not None and doc_id < 100:
            base = private_data.base_spans(rows[doc_id][1])
            listed = ",".join(f"{k}:{a}:{b}" for k in private_data.KINDS for a, b in sorted(base[k]))
            assert digest == hashlib.sha256(listed.encode()).hexdigest()
            assert counts == [len(base[k]) for k in private_data.KINDS]
            assert set(filter(None, listed.split(","))) <= set(spans.split(",")) and len(spans.split(",")) == sum(counts) + added


def test_sample_of_a_field_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(private_data, "SAMPLE", 30)
    rows = [(i, f"x{i}@y.org") for i in range(400)] + [(1, "x1@y.org")] * 200
    seen = []
    monkeypatch.setattr(private_data, "train", lambda graphs: seen.append(sum(len(g.features) for g in graphs)))
    private_data.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    assert seen == [30]
