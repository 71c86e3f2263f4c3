"""Secret scan with a random forest that removes false findings, in DataFrame functions only.

Words (runs without x20, x09-x0D) are cut into values at quotes, brackets, ",", "&",
";", "=" and ":" and around whole known formats. Values joined by "=" or ":" form a
chain, also over blanks; a value's key is the first one before it in its chain that
names a credential, else the one just before it. A finding is a value that mixes
letters and digits, is a long number, has a known format or stands behind a key that
names a credential. Its features are the value's length, changes between upper case,
lower case, digits and signs, shares of these classes, how many of its letters are
words of the corpus (dictionary coverage), whether it is a path or address, and whether
its key or a neighbouring word names a credential.

The forest learns from labelled findings. Without labels of one's own the strict formats
of ``KNOWN`` (true; hex only behind a key that names a credential) and ``HARMLESS``
(false) label the findings they match; those patterns are not features, so the forest
also judges findings of no known format. Hard negatives are hex values, UUIDs and
identifiers behind neutral words (commit, md5, id), and each hex value labelled true
once more without its key: a bare checksum looks the same.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from shelfline.llm.common import Scratch, bounded_sample, prepare
from shelfline.llm.quality import let, words_of

# Formats of issued credentials, by kind; a hex value counts only behind a key that names a credential.
KNOWN = {
    "aws_key": r"^(AKIA|ASIA)[0-9A-Z]{16}$",
    "github_token": r"^gh[pousr]_[0-9A-Za-z]{36}$",
    "slack_token": r"^xox[abprs]-[0-9A-Za-z-]{10,}$",
    "web_token": r"^eyJ[0-9A-Za-z_-]+\.[0-9A-Za-z_-]+\.[0-9A-Za-z_-]+$",
    "hex_secret": r"^([0-9a-f]{16,}|[0-9A-F]{16,})$",
}
# Words that name a credential.
NAMING = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|credential|api[_-]?key|access[_-]?key|auth)"
#: A key names a credential by its end ("db_password", "authToken2", not "author").
NAMING_KEY = NAMING + r"s?([_-]?(key|value|string|hash))?[0-9_-]*$"
# Words that name checksums and identifiers.
NEUTRAL = r"(?i)(?<![a-z])(commit|revision|rev|sha[0-9_-]*|md5|crc(32)?|checksum|digest|hash|etag|(uu|gu)?id|part|sku|order|serial|version|build|model|isbn|ref)(?![a-z])"
# Checksums and identifiers, false behind neutral words.
IDENTIFIER = r"(?i)^([0-9a-f]{7,}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9a-z]+([._/-][0-9a-z]+)*)$"
# Shapes of values that are no secrets.
HARMLESS = r"^([0-9 .()+-]+|[^@]+@[^@]+\.[a-z]{2,}|[0-9]{1,3}(\.[0-9]{1,3}){3}|(//|www\.).*|[0-9]{4}-[0-9]{2}-[0-9]{2}.*|v?[0-9]+(\.[0-9]+)+)$"

FEATURES = ["length", "changes", "distinct", "upper", "lower", "digit", "sign", "coverage", "path", "address", "named", "named_near", "neutral", "neutral_near"]
#: Most labelled findings the forest learns from, by label.
SAMPLE = 20_000
MIN_LENGTH = 8
#: Documents a word must occur in to count as one of the corpus.
MIN_DOCUMENTS = 5


_WRAP = r"""["'`(){}\[\]<>“”‘’«»]"""
_CUT = r"""\x20"'`(){}\[\]<>“”‘’«»,&;=:"""
#: Values joined by "=" or ":"; possessive, so that long chains need no stack.
_CHAIN = rf"[^{_CUT}]++(?:{_WRAP}*+[=:]++{_WRAP}*+[^{_CUT}]++)*+"
_ISSUED = "|".join(f"(?:{p.strip('^$')})" for k, p in KNOWN.items() if k != "hex_secret")
#: Characters of a word before that are searched for a key.
_KEY_LENGTH = 120


def _chain_values(chain: Column) -> Column:
    """key and value of each value of a chain."""

    def keyed(values: Column) -> Column:
        naming = F.filter(F.transform(values, lambda v, i: F.when(v.rlike(NAMING_KEY), i)), lambda i: i.isNotNull())
        return let(
            F.coalesce(F.get(naming, F.lit(0)), F.lit(2**31 - 1)),
            lambda first: F.transform(
                values,
                lambda v, i: F.struct(
                    F.substring(F.coalesce(F.when(first < i, F.get(values, first)).otherwise(F.get(values, i - 1)), F.lit("")), -_KEY_LENGTH, _KEY_LENGTH).alias("key"),
                    F.regexp_replace(v, r"(?<![.!?])[.!?]++$", "").alias("value"),
                ),
            ),
        )

    return let(F.regexp_extract_all(chain, F.lit(f"[^{_CUT}]++"), F.lit(0)), keyed)


def _word_values(words: Column, w: Column, i: Column) -> Column:
    """part (number in the word), key and value of each value of a word."""
    before = F.concat_ws(" ", *(F.substring(F.get(words, i - k), -_KEY_LENGTH, _KEY_LENGTH) for k in (2, 1)))
    lead = F.regexp_extract(w, f"^(?:{_WRAP}|[=:])*+", 0)
    key = F.regexp_extract(F.concat_ws(" ", before, lead), rf"([^{_CUT}]++)(?:{_WRAP}|\x20)*+[=:]++(?:{_WRAP}|[=:]|\x20)*+$", 1)

    def values(key: Column) -> Column:
        cut = F.regexp_replace(F.regexp_replace(w, r"""\\++(?=["'])""", ""), rf"(?<![0-9A-Za-z_])({_ISSUED})(?![0-9A-Za-z_])", "\u00ab$1\u00bb")
        rest = F.regexp_replace(cut, f"^(?:{_WRAP}|[=:])++", "")
        # A key in the words before becomes the first value of the first chain, and is dropped again.
        text = F.when((key != "") & ~rest.rlike("^[,&;]"), F.concat(key, F.lit("="), rest)).otherwise(cut)
        found = F.flatten(F.transform(F.regexp_extract_all(text, F.lit(_CHAIN), F.lit(0)), _chain_values))
        numbered = F.transform(found, lambda x, j: F.struct(j.alias("part"), x["key"].alias("key"), x["value"].alias("value")))
        return F.filter(numbered, lambda x: (x["part"] > 0) | (key == "") | rest.rlike("^[,&;]"))

    return let(key, values)


def _findings(words: Column) -> Column:
    """Findings of one text: place, part, key, value near and neutral_near: whether the two words before or the one after name a credential or an identifier."""

    def described(w: Column, i: Column) -> Column:
        near = F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), F.get(words, i + 1))
        return let(
            let(near, lambda t: F.struct(t.rlike(NAMING).alias("naming"), t.rlike(NEUTRAL).alias("neutral"))),
            lambda n: F.transform(
                F.filter(_word_values(words, w, i), is_finding),
                lambda x: F.struct(
                    i.cast("long").alias("place"), x["part"].alias("part"), x["key"].alias("key"), x["value"].alias("value"),
                    n["naming"].alias("near"), n["neutral"].alias("neutral_near"),
                ),
            ),
        )

    def is_finding(x: Column) -> Column:
        value = x["value"]
        mixed = (F.length(value) >= MIN_LENGTH) & value.rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]|[0-9]{12}")
        behind_key = x["key"].rlike(NAMING_KEY) & value.rlike(r"[0-9\p{L}]")
        return mixed | behind_key | (kind_of(value, x["key"]) != "other")

    # Most words hold neither a digit nor a key or the start of a known format, and this cheap test spares them the rest.
    def possible(w: Column, i: Column) -> Column:
        return w.rlike("[0-9=:]|AKIA|ASIA|gh[pousr]_|xox|eyJ") | F.coalesce(F.get(words, i - 1).rlike(f"[=:]{_WRAP}*+$"), F.lit(False))

    return F.flatten(F.filter(F.transform(words, lambda w, i: F.when(possible(w, i), described(w, i))), lambda x: x.isNotNull()))


def find(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """row (a number of its own), doc_id, findings: one row per document, written once."""
    found = docs.select("doc_id", let(words_of(F.coalesce("text", F.lit(""))), _findings).alias("findings"))
    return scratch.write(found.select(F.monotonically_increasing_id().alias("row"), "doc_id", "findings"), "findings")


def corpus_words(docs: DataFrame) -> DataFrame:
    """Words of letters, lower-cased, that MIN_DOCUMENTS documents hold; counted before they are shuffled."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?<![0-9A-Za-z_])[a-z]{3,}(?![0-9A-Za-z_])"), F.lit(0)))
    return docs.select(F.explode(words).alias("piece")).groupBy("piece").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_DOCUMENTS).select("piece")


def _covered(findings: DataFrame, dictionary: DataFrame) -> DataFrame:
    """row, place, part, letters_known: letters of each value that lie in words of the dictionary."""
    pieces = findings.select("row", "place", "part", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("piece"))
    known = pieces.select("piece").distinct().join(dictionary, "piece", "left_semi")
    return pieces.join(known, "piece").groupBy("row", "place", "part").agg(F.sum(F.length("piece")).alias("letters_known"))


def features(findings: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Findings (row, doc_id, place, part, key, value, near, neutral_near) with the columns FEATURES."""
    value, size = F.col("value"), F.length("value")

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / size

    changes = F.regexp_count(value, F.lit("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^0-9A-Za-z])(?=[0-9A-Za-z])"))
    letters = F.regexp_count(value, F.lit("[A-Za-z]"))
    rows = findings.join(_covered(findings, dictionary), ["row", "place", "part"], "left")
    as_number = lambda c: c.cast("double")
    return rows.withColumns(
        {
            "length": as_number(F.least(size, F.lit(200))),
            "changes": changes / size,
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / size,
            "upper": share("[A-Z]"),
            "lower": share("[a-z]"),
            "digit": share("[0-9]"),
            "sign": share("[^0-9A-Za-z]"),
            "coverage": F.coalesce(F.col("letters_known") / letters, F.lit(0.0)),
            "path": as_number(value.rlike(r"[\\/]|\.[a-z]{2,4}$")),
            "address": as_number(value.rlike("@|^//")),
            "named": as_number(F.col("key").rlike(NAMING_KEY)),
            "named_near": as_number(F.col("near")),
            "neutral": as_number(F.col("key").rlike(NEUTRAL)),
            "neutral_near": as_number(F.col("neutral_near")),
        }
    ).drop("letters_known")


def kind_of(value: Column, key: Column) -> Column:
    """The known format a value behind a key has, else "other"."""
    found = F.lit("other")
    for kind, pattern in reversed(KNOWN.items()):
        matches = value.rlike(pattern) & key.rlike(NAMING_KEY) if kind == "hex_secret" else value.rlike(pattern)
        found = F.when(matches, kind).otherwise(found)
    return found


def labelled(findings: DataFrame) -> DataFrame:
    """Findings (with FEATURES) that the strict formats settle, with label 1.0 or 0.0, and hex values again without what names them as 0.0."""
    value, kind = F.col("value"), kind_of(F.col("value"), F.col("key"))
    neutral = ((F.col("neutral") > 0) | (F.col("neutral_near") > 0)) & (F.col("named") == 0) & (F.col("named_near") == 0)
    harmless = value.rlike(HARMLESS) | (neutral & value.rlike(IDENTIFIER))
    told = findings.withColumn("label", F.when(kind != "other", 1.0).when(harmless, 0.0)).where("label is not null")
    nameless = {"named": F.lit(0.0), "named_near": F.lit(0.0), "label": F.lit(0.0)}
    return told.unionByName(told.where(kind == "hex_secret").withColumns(nameless))


def train(rows: DataFrame, trees: int = 30, depth: int = 6, seed: int = 7) -> PipelineModel | None:
    """A forest from at most SAMPLE findings of each label (columns FEATURES and label), or None if a label is missing."""
    order = F.xxhash64("doc_id", "value", "place", "part")
    parts = [bounded_sample(rows.where(F.col("label") == label), order, SAMPLE) for label in (0.0, 1.0)]
    if any(part.limit(1).count() == 0 for part in parts):
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label")
    sample = vectors.transform(parts[0].unionByName(parts[1])).select("features", "label")
    # A fitted forest holds its training summary and by it the session, which no task can take along once the session has observed a query; a copy has none.
    return PipelineModel([vectors, forest.fit(sample).copy()])


def scan(docs: DataFrame, min_score: float = 0.5, own_labels: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, findings).

    Findings: row, doc_id, place (number of the word, from 0), part (of the word), key,
    value, kind, score, secret. Documents, one row each: doc_id, n_findings, n_secrets,
    kinds (distinct, sorted, comma-joined), places (the word of each secret), score (the best one, else 0).
    A null text has no findings; repeated rows are judged one by one. If nothing
    teaches the forest one of the labels, known formats score 1 and all others 0.
    ``own_labels`` (value, label) replaces the labels of the strict formats.
    """
    scratch = Scratch(prepare(docs.sparkSession), "secrets")
    docs = docs.select("doc_id", "text")
    base = find(docs, scratch)
    single = base.select("row", "doc_id", F.explode("findings").alias("f")).select("row", "doc_id", "f.*")
    dictionary = scratch.write(corpus_words(docs), "dictionary")
    described = scratch.write(features(single, dictionary).withColumn("kind", kind_of(F.col("value"), F.col("key"))), "features")
    scratch.drop(dictionary)
    taught = labelled(described) if own_labels is None else described.join(own_labels.select("value", F.col("label").cast("double").alias("label")).distinct(), "value")
    model = train(taught)
    if model is None:
        judged = described.withColumn("score", (F.col("kind") != "other").cast("double"))
    else:
        judged = model.transform(described).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    columns = ["row", "doc_id", "place", "part", "key", "value", "kind", "score"]
    findings = scratch.write(judged.select(*columns, (F.col("score") >= min_score).alias("secret")), "judged")
    secret = F.col("secret")
    by_row = findings.groupBy("row").agg(
        F.count_if(secret).alias("n_secrets"),
        F.array_join(F.array_sort(F.collect_set(F.when(secret, F.col("kind")))), ",").alias("kinds"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(secret, F.col("place")))), lambda p: p.cast("string")), ",").alias("places"),
        F.max("score").alias("score"),
    )
    documents = (
        base.select("row", "doc_id", F.size("findings").cast("long").alias("n_findings"))
        .join(by_row, "row", "left")
        .select(
            "doc_id", "n_findings", F.coalesce("n_secrets", F.lit(0)).cast("long").alias("n_secrets"),
            F.coalesce("kinds", F.lit("")).alias("kinds"), F.coalesce("places", F.lit("")).alias("places"), F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )
    return documents, findings
