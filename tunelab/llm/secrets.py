"""Secret scan: candidates by pattern, false positives removed by a random forest."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelab.llm.common import stored

LENGTH = 16
#: A run of key characters of the least length or more, with a digit in it.
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{{{LENGTH},}}+"
#: Characters before and after a candidate that are looked at.
CONTEXT = 60
#: Labelled findings used for training at most, and documents from which they are made.
FINDINGS, SAMPLE_DOCS = 20_000, 1_500
#: Occurrences that make a run of letters a dictionary word.
MIN_COUNT = 5
TREES, DEPTH, SEED = 40, 8, 7
_SECRET = "token secret key apikey password passwd pwd auth authorization credential credentials bearer private access"
_PLAIN = (
    "commit sha sha1 sha256 md5 hash checksum digest revision version build id uuid isbn card phone tel order invoice page "
    "etag integrity"
)
SECRET_WORDS, PLAIN_WORDS = (rf"(?i)\b({'|'.join(words.split())})\b" for words in (_SECRET, _PLAIN))
FEATURES = (
    "chars digits uppers symbols distinct_chars class_changes repeats transition coverage slashes in_path extension quoted "
    "assigned secret_word plain_word"
).split()


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, same, start, candidate, before, after): every candidate of the whole texts, with what surrounds it."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = docs.select("doc_id", F.xxhash64("text").alias("same"), F.regexp_extract_all(text, F.lit(CANDIDATE), 0).alias("hits"), text.alias("text"))
    cut = cut.where(F.size("hits") > 0).withColumn("gaps", F.split("text", CANDIDATE, -1))
    sizes = F.zip_with("hits", F.slice("gaps", F.lit(1), F.size("hits")), lambda hit, gap: F.char_length(hit) + F.char_length(gap))
    grown = F.aggregate(sizes, F.array(F.lit(0).cast("long")), lambda ends, n: F.concat(ends, F.array(F.element_at(ends, -1) + n)))
    cut = cut.withColumn("ends", grown)
    near = F.transform(
        "hits",
        lambda hit, i: F.struct(
            (F.element_at("ends", i + 1) + F.char_length(F.get("gaps", i))).alias("start"),
            hit.alias("candidate"),
            F.right(F.get("gaps", i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get("gaps", i + 1), F.lit(CONTEXT)).alias("after"),
        ),
    )
    rows = cut.select("doc_id", "same", F.explode(near).alias("hit")).select("doc_id", "same", "hit.*")
    return rows.select("doc_id", "same", "start", "candidate", "before", "after")


def dictionary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): runs of three or more letters a-z of all texts, lower-cased, that occur ``min_count`` times or more."""
    runs = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), 0)
    words = docs.where("text is not null").select(F.explode(runs).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def transitions(words: DataFrame) -> DataFrame:
    """(pair, logp): log probability of a letter after another in the dictionary, 26 x 26 rows at most."""
    at = F.sequence(F.lit(1), F.char_length("word") - 1)
    pairs = words.select("n", F.explode(F.transform(at, lambda i: F.substr("word", i, F.lit(2)))).alias("pair"))
    pairs = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.substring("pair", 1, 1)))
    return pairs.select("pair", F.log(F.col("n") / total).alias("logp"))


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.char_length("candidate")


def features(found: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add the columns FEATURES to rows that have candidate, before and after.

    Transitions and dictionary coverage are worked out once per distinct candidate, by joins on its pairs and letter runs;
    a candidate that many rows share is one row there.  The result is written, so that the stage of the forest holds nothing else.
    """
    texts = stored(found.select("candidate").distinct().withColumn("lower", F.lower("candidate")), "candidates")
    at = F.sequence(F.lit(1), F.char_length("lower") - 1)
    steps = texts.select("candidate", F.explode(F.transform(at, lambda i: F.substr("lower", i, F.lit(2)))).alias("pair"))
    steps = steps.join(F.broadcast(pairs), "pair", "left").groupBy("candidate").agg(F.avg(F.coalesce("logp", F.lit(-9.0))).alias("transition"))
    runs = texts.select("candidate", F.explode(F.regexp_extract_all("lower", F.lit("[a-z]{3,}"), 0)).alias("word"))
    known = runs.join(words.select("word"), "word").groupBy("candidate").agg(F.sum(F.char_length("word")).alias("known"))
    per = stored(steps.join(known, "candidate", "left"), "candidate-features")
    rows = found.join(per, "candidate")
    last, first = F.col("before"), F.col("after")
    rated = rows.select(
        *found.columns,
        F.char_length("candidate").cast("double").alias("chars"),
        _share("[0-9]").alias("digits"),
        _share("[A-Z]").alias("uppers"),
        _share("[^A-Za-z0-9]").alias("symbols"),
        (F.size(F.array_distinct(F.split("candidate", ""))) / F.char_length("candidate")).alias("distinct_chars"),
        _share("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])").alias("class_changes"),
        _share(r"(.)(?=\1)").alias("repeats"),
        "transition",
        (F.coalesce("known", F.lit(0)) / F.char_length("candidate")).alias("coverage"),
        F.regexp_count("candidate", F.lit("/")).cast("double").alias("slashes"),
        last.rlike(r"(://\S*|[/\\.])$").cast("double").alias("in_path"),
        first.rlike(r"^\.[A-Za-z0-9]{1,5}\b").cast("double").alias("extension"),
        (last.rlike("[\"'`]$") & first.rlike("^[\"'`]")).cast("double").alias("quoted"),
        last.rlike("[=:]\\s*[\"'`]?$").cast("double").alias("assigned"),
        F.right(last, F.lit(30)).rlike(SECRET_WORDS).cast("double").alias("secret_word"),
        F.right(last, F.lit(30)).rlike(PLAIN_WORDS).cast("double").alias("plain_word"),
    )
    return stored(rated, "features")


def made_findings(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(candidate, before, after, label): labelled findings made from the words of a bounded sample of documents.

    Secrets are random keys of usual shapes, with and without a telling word before them; false positives are
    identifiers, paths, versions, numbers, checksums and repeated characters, all drawn by hash of doc_id.  Use
    reviewed findings instead where there are any.
    """
    ids = docs.where("doc_id is not null and text is not null").select("doc_id").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    some = stored(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").where("text is not null"), "sample-docs")
    words = F.regexp_extract_all("text", F.lit(r"\p{L}{2,}"), 0)
    some = some.select(F.col("doc_id").cast("string").alias("d"), words.alias("w")).where(F.size("w") > 0)

    def word(k: int) -> Column:
        return F.get("w", F.pmod(F.xxhash64("d", F.lit(k)), F.size("w")).cast("int"))

    def hexes(k: int, n: int) -> Column:
        return F.left(F.sha2(F.concat_ws(":", "d", F.lit(k)), 256), F.lit(n))

    def base(k: int, n: int) -> Column:
        return F.left(F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat_ws(":", "d", F.lit(k)), 512))), "[+/=\n]", ""), F.lit(n))

    def digits(k: int, n: int) -> Column:
        return F.left(F.concat(*[F.lpad(F.pmod(F.xxhash64("d", F.lit(k + i)), F.lit(10**9)).cast("string"), 9, "0") for i in range(4)]), F.lit(n))

    def ascii(k: int) -> Column:
        return F.regexp_replace(word(k), "[^A-Za-z]", "e")

    lead, tail = F.concat(word(1), F.lit(" "), word(2), F.lit(" ")), F.concat(F.lit(" "), word(3), F.lit(" "), word(4))
    prefixed = [F.concat(F.lit("AKIA"), F.upper(hexes(4, 16))), F.concat(F.lit("ghp_"), base(5, 36))]
    keys = [hexes(1, 40), hexes(2, 32), base(3, 40), *prefixed, base(6, 24), hexes(7, 64)]
    named = [("token = \"", "\""), ("api_key: ", ""), ("secret='", "'"), ("password=", "")]
    named += [("Authorization: Bearer ", ""), ("private key ", "")]
    plain = [
        (F.concat(ascii(11), F.lit("_"), ascii(12), F.lit("_"), ascii(13), F.lit("_"), digits(14, 4)), "", ""),
        (F.concat(F.lit("/"), ascii(15), F.lit("/"), ascii(16), F.lit("/"), ascii(17), F.lit("-"), digits(18, 3)), "", ".html"),
        (F.concat(ascii(19), ascii(20), ascii(21), digits(22, 2)), "", ""),
        (digits(23, 16), "", ""),
        (digits(24, 18), "card ", ""),
        (F.concat(digits(25, 4), F.lit("-"), digits(26, 2), F.lit("-"), digits(27, 2), F.lit("_"), digits(28, 6), F.lit("-build")), "version ", ""),
        (hexes(29, 40), "commit ", ""),
        (hexes(30, 64), "sha256: ", ""),
        (hexes(31, 32), "md5 checksum ", ""),
        (F.concat(F.lit("https"), F.lit("/"), ascii(32), F.lit("/"), ascii(33), F.lit("/"), digits(34, 6)), "id=", "?page"),
        (F.concat(F.repeat(F.left(hexes(35, 1), F.lit(1)), F.lit(20)), F.lit("0")), "key ", ""),
        (F.concat(F.repeat(F.lit("="), F.lit(30)), digits(36, 1)), "", ""),
        (F.concat(ascii(37), F.lit("-"), ascii(38), F.lit("-"), ascii(39), F.lit("-"), digits(40, 2)), "key = \"", "\""),
    ]
    rows = [(key, F.concat(lead, F.lit(b)), F.concat(F.lit(a), tail), 1) for i, key in enumerate(keys) for b, a in (named[i % 6], named[(i + 1) % 6])]
    rows += [(keys[2], lead, tail, 1), (keys[4], lead, tail, 1)]
    rows += [(c, F.concat(lead, F.lit(b)), F.concat(F.lit(a), tail), 0) for c, b, a in plain]
    parts = [x for c, b, a, _ in rows for x in (c, b, a)]
    some = stored(some.select("d", *[part.alias(f"x{i}") for i, part in enumerate(parts)]), "made")
    made = []
    for i, row in enumerate(rows):
        texts = [F.col(f"x{3 * i + j}").alias(name) for j, name in enumerate(("candidate", "before", "after"))]
        made.append(F.struct(*texts, F.lit(row[3]).alias("label")))
    found = some.select("d", F.explode(F.array(*made)).alias("f")).select("d", "f.*")
    found = found.where(F.col("candidate").rlike(f"^{CANDIDATE}$")).orderBy(F.xxhash64("d", "candidate")).limit(FINDINGS)
    return found.select("candidate", "before", "after", "label")


def train(findings: DataFrame, words: DataFrame, pairs: DataFrame) -> PipelineModel:
    """A random forest over the features of labelled findings; of more than FINDINGS the first in hash order."""
    some = findings.orderBy(F.xxhash64("candidate", "before", "after"), "label").limit(FINDINGS)
    table = stored(features(some, words, pairs).coalesce(1).sortWithinPartitions("candidate", "before", "after"), "findings")
    forest = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="vector"), forest]).fit(table)


def scan(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, start, candidate, score, is_secret): every candidate with its probability of being a secret.

    A candidate is a run of 16 or more letters, digits and ``+/_=-`` with a digit; ``start`` is its code point offset.  The
    forest sees its length, character classes, letter transitions, dictionary coverage, path and neighbouring words.  It is
    trained on ``findings`` (candidate, before, after, label), at most FINDINGS of them; without any they are
    made from a bounded sample of the documents.  The dictionary and the transitions come from all texts.

    Null and empty texts have no candidates.  Rows that repeat a document are scanned each.  A null doc_id is returned as
    such.  Without dictionary or findings, in an empty table, the result is empty.  Other columns are ignored.
    """
    words = stored(dictionary(docs), "dictionary")
    pairs = stored(transitions(words), "transitions")
    found = stored(candidates(docs), "secret-candidates")
    empty = found.select("doc_id", "start", "candidate", F.lit(0.0).alias("score"), F.lit(False).alias("is_secret"))
    if found.isEmpty():
        return empty
    known = stored(findings if findings is not None else made_findings(docs), "labelled")
    if known.select("label").distinct().count() < 2:
        return empty
    rated = train(known, words, pairs).transform(features(found, words, pairs))
    score = F.round(F.get(vector_to_array("probability"), F.lit(1)), 6)
    return rated.select("doc_id", "start", "candidate", score.alias("score"), (score >= threshold).alias("is_secret"))
