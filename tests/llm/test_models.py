"""Token files, language, quality, secrets and mixing."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import Observation, functions as F

from shelfline.llm import language, mixing, quality, secrets, token_files
from shelfline.llm.queries import TOKENIZER, domain_of_source, target_weight
from shelfline.session import scratch_path


@pytest.mark.parametrize("ids", [[], [0], [1] * 3000, [2**64 - 1, 2**60, 5], list(range(5000)), [15 << 60, 15 << 60, 3]])
def test_code_round_trip(ids):
    values = np.array(ids, np.uint64)
    payload = token_files.encode(values)
    assert (token_files.decode(payload) == values).all()
    assert (token_files.decode(payload, 1030, 2500) == values[1030:2500]).all()


def test_code_of_random_widths():
    rng = np.random.default_rng(1)
    values = (rng.integers(0, 2**62, 20_000) >> rng.integers(0, 62, 20_000)).astype(np.uint64)
    assert (token_files.decode(token_files.encode(values)) == values).all()


def test_token_files(spark, docs, texts, no_docs):
    from tokenizers import Tokenizer

    path = token_files.tokenizer_path(TOKENIZER)
    odd = [(900, "two  blanks \n here\tthere \n"), (901, "a<|endoftext|>b c"), (None, "no id"), (900, "again")]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    target = scratch_path(spark, "test-tokens")
    token_files.write_token_files(both, target, path)
    got = [tuple(r) for r in token_files.read_token_files(spark, target, with_ids=True).orderBy("start").collect()]
    tokenizer, start, expected = Tokenizer.from_file(path), 0, []
    for doc, text in sorted([*texts, *odd], key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert got == expected
    empty = scratch_path(spark, "test-tokens")
    token_files.write_token_files(no_docs, empty, path)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_ids_equal_the_library_around_all_blanks(monkeypatch):
    """Blanks of every kind beside each other, letters, marks, digits and special tokens; the remembered pieces overflow on the way."""
    monkeypatch.setattr(token_files, "MEMORY", 3000)
    monkeypatch.setattr(token_files, "JOINED", 7)
    rng = random.Random(7)
    coder = token_files.Tokens(token_files.tokenizer_path(TOKENIZER))
    blanks = [chr(c) for c in (*range(0x20), 0x20, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF)]
    letters = ["a", "the", "it's", "12", "é", "漢", "...", "#", "'", "\u0301", "😀"]
    for k in range(200):
        texts = ["".join(rng.choice((rng.choice(blanks), rng.choice(letters), " ")) for _ in range(rng.randint(0, 14))) for _ in range(100)]
        texts += ["a <|endoftext|> b", " <|endoftext|>", "x" * 300 + " y"] if k % 10 == 0 else []
        wanted = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids.tolist() for ids in coder.ids(texts)] == wanted
    assert not any(len(piece) > token_files.LONG_PIECE for piece in coder.known)


def test_pieces_met_first_stay_remembered(monkeypatch):
    monkeypatch.setattr(token_files, "MEMORY", 100)
    coder = token_files.Tokens(token_files.tokenizer_path(TOKENIZER))
    common = [f"often{i}" for i in range(20)]
    coder.ids(["head " + " ".join(common)])
    coded, code = [], coder._code
    monkeypatch.setattr(coder, "_code", lambda texts: coded.extend(texts) or code(texts))
    for turn in range(10):
        text = "head " + " ".join([*common, *(f"rare{turn}x{i}" for i in range(20))])
        assert coder.ids([text])[0].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert len(coder.known) <= token_files.MEMORY
    assert not any("often" in text for text in coded)


def test_words_are_coded_once_whatever_sign_follows(monkeypatch):
    coder = token_files.Tokens(token_files.tokenizer_path(TOKENIZER))
    coder.ids(["head garden\nété ..."])
    coded, code = [], coder._code
    monkeypatch.setattr(coder, "_code", lambda texts: coded.extend(texts) or code(texts))
    text = "head garden, garden. garden;\nété\nété! garden: garden\nété..."
    assert coder.ids([text])[0].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert coded and not any("garden" in text or "été" in text for text in coded)


def test_ids_equal_the_library_around_signs():
    """Signs, apostrophes and line ends beside letters of Latin-1 and beyond, digits and blanks; long pieces and empty texts."""
    rng = random.Random(11)
    coder = token_files.Tokens(token_files.tokenizer_path(TOKENIZER))
    signs = [chr(c) for c in range(0x21, 0x7F)]
    latin = [chr(c) for c in range(0xA0, 0x180)]
    parts = ["the", "12", "it's", "'ll", "'", "\u0301", "漢", "😀", " ", " ", "\n", "\n\n", "\r\n", "\t", "  "]
    for _ in range(100):
        texts = ["".join(rng.choice(rng.choice((signs, latin, parts))) for _ in range(rng.randint(0, 20))) for _ in range(100)]
        texts += ["a.<|endoftext|>,b", "x" * 300 + ", y.", ". " * 200]
        wanted = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [ids.tolist() for ids in coder.ids(texts)] == wanted


def test_texts_are_cut_in_bounded_runs(monkeypatch):
    """Batches of long texts do not make arrays for all their bytes at once, wherever the runs end."""
    coder = token_files.Tokens(token_files.tokenizer_path(TOKENIZER))
    texts = ["", "", "one two, three " * 40, "", "a<|endoftext|>b", "long " * 3000, "x", " y", "", "words (and) signs. " * 100, ""] * 3
    runs, borders = [], token_files._borders
    monkeypatch.setattr(token_files, "_borders", lambda raw: runs.append(len(raw)) or borders(raw))
    monkeypatch.setattr(token_files, "CUT", 1000, raising=False)
    got = coder.ids(pa.array([*texts, None, "end"]).fill_null("")[1:])
    assert [x.tolist() for x in got] == [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in [*texts[1:], "", "end"]]
    assert sum(runs) == sum(len(t) for t in texts) + 3 and max(runs) < 1000 + max(map(len, texts))
    assert coder.ids([]) == [] and [len(x) for x in coder.ids(["", ""])] == [0, 0]


def test_token_files_are_read_without_shuffling_the_payloads(spark, docs):
    target = scratch_path(spark, "test-tokens")
    token_files.write_token_files(docs, target, TOKENIZER)
    plan = token_files.read_token_files(spark, target)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "rightHint=(strategy=broadcast)" in plan


def test_trusted_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE", 100)
    labels = spark.range(5000).selectExpr("id % 4000 as doc_id")
    found = [r[0] for r in quality.trusted_ids(labels).collect()]
    assert len(found) == len(set(found)) == 100
    assert sorted(r[0] for r in quality.trusted_ids(labels.repartition(7)).collect()) == sorted(found)
    assert quality.trusted_ids(labels.limit(60)).count() <= 60


def test_language(spark, no_docs):
    rng = random.Random(4)
    parts = {"xx": "ba ko li mu ne".split(), "yy": "strö schü wenf ölk arz".split()}
    text = lambda lang, n: " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(lang, 40), lang) for i, lang in enumerate(["xx", "xx", "yy"] * 60)]
    docs = spark.createDataFrame([*rows, (900, None, "xx"), (901, "12 !", "xx"), (902, "", None), (None, text("yy", 9), None)], "doc_id long, text string, lang string")
    filters = language.learn(docs)
    got = language.identify(docs, filters).collect()
    assert len(got) == len(rows) + 4
    pred = {r["doc_id"]: r["lang_pred"] for r in got}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(pred[i] == lang for i, lang in held)
    assert [pred[i] for i in (900, 901, 902, None)] == ["und", "und", "und", "yy"]
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = language.in_known_language(docs, filters)
    assert kept.columns == docs.columns and kept.count() == len(rows) + 1
    nothing = language.learn(no_docs)
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}


def base_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_quality(spark, docs, texts, no_docs):
    more = [(500, "one line\none line\n \n \none line # * two\n" * 9), (501, "a b c d a b c a b c " * 6), (502, "ÄÖ 😀 x y " * 30), (500, "<|>")]
    some = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, 1, 0), (31, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.judge(some, labels).collect()
    key = lambda r: (r[0], r[1:])
    assert sorted(key(tuple(r)[:7]) for r in got) == sorted((d, base_quality(t)) for d, t in [*texts, *more])
    # The likelihood ratio, counted again in plain Python.
    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        one = lambda w, seed=42: xxhash.xxh64_intdigest(w.encode(), seed)
        hashes = [one(w) for w in words] + [one(b, one(a)) for a, b in zip(words, words[1:], strict=False)]
        return [h % quality.BUCKETS for h in hashes]

    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for d, t in [*texts, *more]:
        np.add.at(raw, grams(t), 1)
        if d < 30:
            np.add.at(target, grams(t), 1)
    share = (raw + 1) / (raw.sum() + quality.BUCKETS)
    ratio = np.log((target + quality.PRIOR * share) / (target.sum() + quality.PRIOR) / share)
    whole = np.round(ratio * 1e6)
    scores = {d: whole[grams(t)].sum() / max(1, len(grams(t))) / 1e6 for d, t in texts}
    for r in got:
        if r["doc_id"] < 500 and r["n_words"]:
            assert r["score"] == pytest.approx(scores[r["doc_id"]], abs=2e-6)
            assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.MIN_SCORE)
    unlabelled = quality.judge(docs, labels.limit(0)).where("n_words > 0")
    assert unlabelled.where("score <> 0 or kept = base_failed").count() == 0
    assert quality.judge(no_docs, labels).count() == 0
    assert quality.judge(docs, labels.limit(0)).count() == len(texts)


def test_secrets(spark, no_docs):
    rng = random.Random(6)
    key = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    rows = []
    for i in range(60):
        rows.append((i, f"the key AKIA{key('ABCDEFGHJKLMNPQRSTUVWXYZ234567', 16)} was lost, write to bob{i}@host{i}.example.com"))
        rows.append((100 + i, f"password={key('0123456789abcdef', 18)} seen from 10.2.{i}.4 with order 123456789012{i:04}"))
    rows += [(300, None), (301, ""), (302, "plain words only"), (0, "password=" + key("0123456789abcdef", 18))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    documents, findings = secrets.scan(docs)
    got = documents.collect()
    assert len(got) == len(rows)
    assert sum(r["n_secrets"] for r in got) == 121
    assert {r["doc_id"] for r in got if not r["n_findings"]} == {300, 301, 302}
    assert findings.where("secret and value like '%@%'").count() == 0
    assert secrets.scan(no_docs)[0].count() == 0
    # One label alone teaches nothing: the formats decide.
    only = secrets.scan(docs.where("doc_id between 1 and 59").select("doc_id", F.regexp_replace("text", "bob.*", "").alias("text")))[0]
    assert only.agg(F.sum("n_secrets")).first()[0] == 59


def test_secrets_after_an_observed_query(spark):
    """Once a session has observed a query it can't be sent to tasks, so the forest must not hold it."""
    observation = Observation()
    spark.range(3).observe(observation, F.count(F.lit(1)).alias("n")).collect()
    assert observation.get == {"n": 3}
    rng = random.Random(8)
    rows = [(i, f"password={rng.randbytes(9).hex()} seen from 10.2.{i}.4") for i in range(60)]
    documents, findings = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    assert documents.agg(F.sum("n_secrets")).first()[0] == 60
    assert findings.where("value like '10.%' and secret").count() == 0


def test_secrets_of_one_word(spark):
    aws, git = "AKIA" + "Z2" * 8, "ghp_" + "aB3" * 12
    texts = [
        f'{{"id":"{aws}","t":"{git}"}}', f"https://h/x?a=1&key={aws}", f"{aws},{git}", f"export:KEY={aws}", f"see https://u:{git}@h.example/{aws}/x.",
        "password=CorrectHorseBattery", 'login {"user": "bob", "password": "abc"}', "db_password = pa:ss,author: Smith", f'{{\\"t\\":\\"{aws}\\"}}',
        ":".join(["a1"] * 20_000), f'"{aws}"###', "token =, Abcdefgh1", "seen at: noon",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    documents, findings = secrets.scan(docs)
    got = {i: [] for i in range(len(texts))}
    for r in findings.orderBy("place", "part").collect():
        got[r["doc_id"]].append((r["place"], r["key"], r["value"]))
    assert got[0] == [(0, "id", aws), (0, "t", git)]
    assert got[1] == [(0, "key", aws)]
    assert got[2] == [(0, "", aws), (0, "", git)]
    assert got[3] == [(0, "KEY", aws)]
    assert {v for _, _, v in got[4]} >= {aws, git}
    assert got[5] == [(0, "password", "CorrectHorseBattery")]
    assert got[6] == [(4, "password", "abc")]
    assert got[7] == [(2, "db_password", "pa"), (2, "db_password", "ss")]
    assert [v for _, _, v in got[8]] == [aws] and got[10] == [(0, "", aws)]
    assert got[9] == got[12] == [] and got[11] == [(2, "", "Abcdefgh1")]
    by = {r["doc_id"]: r for r in documents.collect()}
    assert [by[i]["n_secrets"] for i in (0, 1, 2, 3, 4, 8, 10)] == [2, 1, 2, 1, 2, 1, 1]
    assert by[2]["places"] == "0,0" and by[2]["kinds"] == "aws_key,github_token"


def test_checksums_are_no_secrets(spark):
    rng = random.Random(9)
    digits = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, clean = [], set()
    for i in range(60):
        n = (17, 18, 20, 32, 40, 64)[i % 6]
        rows.append((i, f"see token = \"{digits(n)}\" and AKIA{'Q7' * 7}{10 + i % 90}"))
        uuid = "-".join(map(digits, (8, 4, 4, 4, 12)))
        rows.append((100 + i, f"commit {digits(40)} with md5 {digits(32)} of id {uuid} and part 7{i}-AB-{digits(6)}x1"))
        rows.append((200 + i, f"sha256:{digits(64)} etag={digits(32)} file {digits(32)} {digits(40)} at {digits(18)} done"))
        clean |= {100 + i, 200 + i}
    documents, findings = secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r["doc_id"]: r for r in documents.collect()}
    assert [found[i]["n_secrets"] for i in range(60)] == [2] * 60
    assert {found[i]["kinds"] for i in range(60)} == {"aws_key,hex_secret"}
    assert all(found[i]["n_findings"] >= 4 for i in clean)
    assert sum(found[i]["n_secrets"] for i in clean) == 0


def test_bare_hex_has_no_known_kind(spark):
    rows = spark.createDataFrame([("", "ab" * 16), ("password", "ab" * 16), ("sha256", "ab" * 32), ("", "ab" * 9), ("api_key", "ab1" * 7)], "key string, value string")
    kinds = [r[0] for r in rows.coalesce(1).select(secrets.kind_of(F.col("value"), F.col("key"))).collect()]
    assert kinds == ["other", "hex_secret", "other", "other", "hex_secret"]


def plain_budgets(tree, budget):
    """Water-filling by repeated rounds on a tree {name: (weight, capacity or subtree)}."""
    def capacity(x):
        return x if isinstance(x, int) else sum(capacity(c) for _, c in x.values())

    out, open_, left = {}, dict(tree), min(budget, capacity(tree))
    while open_:
        weights = sum(w for w, _ in open_.values())
        full = {n: capacity(c) for n, (w, c) in open_.items() if capacity(c) * weights <= w * left}
        if not full:
            break
        out |= full
        left -= sum(full.values())
        open_ = {n: x for n, x in open_.items() if n not in full}
    weights = sum(w for w, _ in open_.values())
    return out | {n: left * w / weights for n, (w, _) in open_.items()}


def test_mixing(spark, docs, texts, no_docs):
    got = mixing.mix_sources(docs, domain_of_source(), target_weight, share=0.6, max_epochs=2).collect()
    counts = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in texts}
    total = sum(counts.values())
    assert sum(r["tokens"] for r in got) == total * 6 // 10
    assert all(r["n_tokens"] == counts[r["doc_id"]] and r["copies"] in (1, 2) and r["tokens"] <= 2 * r["n_tokens"] for r in got)
    domains = {}
    for d, n in counts.items():
        name = f"domain{d % 5 % 4}"
        domains[name] = domains.get(name, 0) + 2 * n
    weight = {"domain0": 4, "domain1": 3, "domain2": 2}
    expected = plain_budgets({n: (weight.get(n, 1), c) for n, c in domains.items()}, total * 6 // 10)
    for name, budget in expected.items():
        assert abs(sum(r["tokens"] for r in got if r["domain"] == name) - budget) < 1
    # At most one document of a leaf is cut, and the others are read in whole epochs.
    leaves = {}
    for r in got:
        leaves.setdefault((r["domain"], r["lang"], r["source"]), []).append(r["tokens"] not in (r["n_tokens"], 2 * r["n_tokens"]))
    assert all(sum(cut) <= 1 for cut in leaves.values())
    assert mixing.mix_sources(no_docs, domain_of_source(), target_weight).count() == 0
    kept = mixing.keep_mixed(docs, domain_of_source(), target_weight, share=0.5)
    assert kept.columns == docs.columns and 0 < kept.count() < len(texts)
    blank = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    assert {(r["domain"], r["lang"]) for r in mixing.mix_sources(blank, domain_of_source(), target_weight).collect()} == {("(none)", "(none)")}
