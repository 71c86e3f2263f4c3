import hashlib
import random
import zlib

import numpy as np
from test_dedup import groups
from test_search import brute

import corpus_pipeline
from shelfline.llm import token_files
from shelfline.llm.queries import QUERIES, TOKENIZER

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == documents.columns
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert ids and ids <= {r[0] for r in docs.select("doc_id").collect()}
        docs = after
    assert corpus_pipeline.run(spark, SMALL).count() == len(ids)


def plain_mix(texts, langs):
    """Ids taken of texts of one domain and source in two languages, weighted 5 to 2: 80 % of all words."""
    size = {i: len(t.split()) for i, t in texts.items()}
    whole = {lang: sum(n for i, n in size.items() if langs[i] == lang) for lang in ("en", "yy")}
    total = sum(whole.values()) * 8 // 10
    weight = {"en": 5, "yy": 2}
    first, second = sorted(whole, key=lambda x: (whole[x] / weight[x], x))
    budget = {first: min(whole[first], total * weight[first] // 7)}
    budget[second] = min(whole[second], total - budget[first])
    taken = set()
    for lang in whole:
        left = budget[lang]
        full = left == whole[lang]
        for i in sorted((i for i in size if langs[i] == lang), key=lambda i: hashlib.md5(f"7:0:{i}".encode()).hexdigest()):
            if full or left > 0:
                taken.add(i)
            left -= size[i]
    return taken


def test_run_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(12)
    parts = {"en": "ba ko li mu ne".split(), "yy": "strö schü wenf ölk arz".split(), "zz": "qxv jzw vqk".split()}
    words = lambda lang, n: ["".join(rng.choice(parts[lang]) for _ in range(4)) for _ in range(n)]
    texts, langs = {}, {}
    for i in range(200):
        langs[i] = "yy" if i % 4 == 0 else "en"
        texts[i] = " ".join(words(langs[i], rng.randint(30, 60)))
    held = [i for i in range(1000, 1200) if zlib.crc32(str(i).encode()) % 4 == 2]
    # Whole and near copies: of about 46 shingles one changed word breaks five, so some pairs reach 0.8 and some do not.
    for i in range(200, 260):
        source = rng.randrange(200)
        copy = texts[source].split(" ")
        for at in rng.sample(range(len(copy)), i % 4):
            copy[at] = words(langs[source], 1)[0]
        texts[i], langs[i] = " ".join(copy), langs[source]
    items = [(j, " ".join(words("en", 14))) for j in range(5)] + [(9, texts[3]), (10, None), (11, "")]
    # A window of ten words is a leak, nine words are none.
    for j in range(5):
        for k, n in ((300 + j, 10), (310 + j, 9)):
            langs[k] = "en"
            texts[k] = " ".join([*words("en", 20), *items[j][1].split(" ")[1 : 1 + n], *words("en", 20)])
    # No known language: nothing, no letters, and unseen words with none or few of a known language.
    lost = dict(zip(held, [None, "", "12 ! 34", " ".join(words("zz", 40)), " ".join([*words("zz", 60), *words("en", 2)])], strict=False))
    some = " ".join([*words("zz", 15), *words("en", 40)])
    texts[held[5]], langs[held[5]] = some, "en"
    rows = [(i, t, langs.get(i, "en"), "src0", len(t or "")) for i, t in (texts | lost).items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    near = groups(list(texts.items()), 5, 80)
    kept = [(i, t) for i, t in texts.items() if near[i][2]]
    assert 20 < len(texts) - len(kept) < 60
    leaks = {i for i, v in brute(kept, items).items() if v[-1]}
    assert leaks >= {300, 301, 302, 303, 304} and not leaks & set(range(310, 315))
    clean = {i: t for i, t in kept if i not in leaks}
    taken = plain_mix(clean, langs)
    assert 0 < len(taken) < len(clean)
    tokenizer, start, expected = Tokenizer.from_file(token_files.tokenizer_path(TOKENIZER)), 0, []
    for i in sorted(taken):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
