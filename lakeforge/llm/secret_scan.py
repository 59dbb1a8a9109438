"""Secret scan: candidates by shape, false positives removed by a random forest.

Every run of key characters that is long and dense enough, every dotted token and every
value assigned to a key word is a candidate, whatever the value's length. Features describe its
length, the transitions between its characters, how much of it the dictionary covers (the
words that documents of the corpus share, and common word parts), the path it was found on and the words beside it. A random forest
trained on labelled findings gives each candidate the probability of being a secret.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bound of the labelled findings a class that the forest is trained on.
SAMPLE = 4000
TREES, DEPTH, SEED = 24, 7, 17
MIN_LENGTH = 16
#: A candidate: a run of key characters in a word, with a digit or a capital behind a small letter.
KEY_CHARS = r"A-Za-z0-9+/_\-"
CANDIDATE = (rf"(?<![{KEY_CHARS}])(?=[{KEY_CHARS}]{{{MIN_LENGTH}}})(?=[{KEY_CHARS}]*?(?:[0-9]|[a-z][A-Z]))"
             rf"[{KEY_CHARS}]+={{0,2}}")
#: Frequent word parts of the languages met; what they cover of a word is no random key.
PARTS = ("tion ing ment the and ent ion her ter ver ere ate ons der die ein sch und ich que les des est "
         "ado mente cion ar er en es re or an on in te de la se con pour para das not ung lich gen "
         "test example sample dummy").split()
#: A word is in the dictionary if it stands by itself in as many documents.
WORD_DOCUMENTS = 5
KEY_WORDS = r"(?i)(pass(word|wd)?|pwd|secret|token|api_?key|access_?key|private_?key|credential|auth|bearer)"
DULL_WORDS = r"(?i)(example|sample|sha\d*|md5|checksum|commit|uuid|isbn|order|invoice|phone|license)"
#: Parts with dots between them, as in web tokens, as one candidate.
DOTTED = (r"(?<![\w.\-])(?=[\w.\-]*?(?:[0-9]|[a-z][A-Z]))(?=[\w\-]+\.[\w\-])"
          rf"[\w\-][\w.\-]{{{MIN_LENGTH - 2},}}[\w\-]={{0,2}}")
#: A key word's name and the sign of assignment behind it, each with its quotes.
_NAME = rf"(?:{KEY_WORDS})[\w\-]{{0,40}}[\\\"'`]{{0,2}}"
_SIGN = r"(?:=>|:=|==|=|:)[\\\"'`]{0,2}"
#: What is assigned to a key word, of 6 characters or more: up to a quote, a blank or the next NAME=.
_NO_NEXT = r"(?![,;&][\w\-]{1,60}[=:])"
VALUE = (rf"(?<=[=:>\\\"'`])(?<={_NAME}{_SIGN})(?![=:>\\\"'`])(?:{_NO_NEXT}[^\"'`]){{5,}}{_NO_NEXT}"
         rf"(?:[^\"'`\\](?=\\?[\"'`])|[^\"'`\\,;])")
TEST_PATH = r"(?i)(test|spec|example|sample|fixture|mock|doc)"


def _met(word: str, pattern: str) -> Column:
    """Array of (label, candidate): what ``pattern`` finds in a word, in order, with what lies in front of each."""
    lead = F.lit(rf"(?s)\G(.*?)({pattern})")
    label, found = (F.regexp_extract_all(word, lead, F.lit(i)) for i in (1, 2))
    return F.zip_with(label, found, lambda x, y: F.struct(x.alias("label"), y.alias("candidate")))


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """(id, path, position, part, candidate, before, label, after): every candidate of every whole text.

    ``position`` is the number of the word, from 0, and ``part`` that of the candidate in
    the word; ``before`` are up to three words in front of it and ``after`` the next one;
    ``label`` is what the word itself holds in front of the candidate, from the one before
    it on, as in ``password=...``.

    Candidates of a word are its runs of key characters, then its dotted tokens, then the
    values of assignments to a key word, which may stand in the words before it; a value
    that is a run or a dotted token is one candidate.
    """
    words = F.filter(F.split(F.coalesce(text_col, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    shaped = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: (
        F.get("_w", i).rlike(f"{CANDIDATE}|{DOTTED}|[=:]")
        | F.coalesce(F.get("_w", i - 1).rlike(rf"{_SIGN}$"), F.lit(False))))
    found = (df.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), words.alias("_w"))
             .where(F.size("_w") > 0)
             .withColumn("position", F.explode(shaped))
             .select("id", "path", "position", F.expr("_w[position]").alias("word"),
                     F.expr("concat_ws(' ', slice(_w, greatest(position - 2, 1), least(position, 3)))").alias("before"),
                     F.coalesce(F.expr("get(_w, position + 1)"), F.lit("")).alias("after"),
                     F.coalesce(F.expr("get(_w, position - 1)"), F.lit("")).alias("prev"),
                     F.coalesce(F.expr("get(_w, position - 2)"), F.lit("")).alias("prev2")))
    # the assignment that the words before end with belongs to the value
    ahead = F.when(F.col("prev").rlike(rf"^{_SIGN}$"), F.concat("prev2", "prev")).otherwise(F.col("prev"))
    ahead = (F.when(F.col("word").rlike("^[=:]"), F.regexp_extract("prev", rf"{_NAME}$", 0))
             .otherwise(F.regexp_extract(ahead, rf"{_NAME}{_SIGN}$", 0)))
    found = found.withColumn("ahead", ahead).withColumn("led", F.concat("ahead", "word"))
    values = F.transform(_met("led", VALUE), lambda x, i: F.struct(
        F.when(i == 0, F.expr("length(ahead)")).otherwise(0).alias("skip"), x["label"].alias("label"),
        x["candidate"].alias("candidate")))
    values = F.transform(F.filter(values, lambda x: ~x["candidate"].rlike(f"^(?:{CANDIDATE}|{DOTTED})$")),
                         lambda x: F.struct(x["label"].substr(x["skip"] + 1, F.length(x["label"])).alias("label"),
                                            x["candidate"].alias("candidate")))
    parts = F.concat(_met("word", CANDIDATE), _met("word", DOTTED), values)
    return (found.select("id", "path", "position", "before", "after", F.posexplode(parts).alias("part", "c"))
            .select("id", "path", "position", "part", "c.candidate", "before", "c.label", "after"))


def dictionary(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(word): lower-cased runs of three letters or more that stand by themselves, not in a path
    or a key, in WORD_DOCUMENTS documents and two different texts at least.

    Each task counts its words before they are shuffled, so frequent ones are one row a task.
    """
    alone = r"(?<![\p{L}\p{N}_+/=\-])\p{L}{3,}(?![\p{L}\p{N}_+/=\-])"
    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    words = df.select(F.xxhash64(text_col).alias("t"), F.explode(F.array_distinct(
        F.regexp_extract_all(text, F.lit(alone), F.lit(0)))).alias("word"))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("one"), F.max("t").alias("other"))
            .where((F.col("n") >= WORD_DOCUMENTS) & (F.col("one") != F.col("other"))).select("word"))


def with_known_share(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with ``known``: the share of the candidate's characters in words of the dictionary.

    A candidate's words are its runs of small letters, with the capital before them, and of
    capitals. Each different candidate is looked up once.
    """
    parts = F.filter(F.transform(F.regexp_extract_all("candidate", F.lit(r"\p{Lu}?\p{Ll}{2,}|\p{Lu}{3,}"), F.lit(0)),
                                 lambda w: F.lower(w)), lambda w: F.length(w) >= 3)
    held = (found.select("candidate").distinct().select("candidate", F.explode(parts).alias("word")).join(words, "word")
            .groupBy("candidate").agg(F.sum(F.length("word")).alias("_held")))
    return (found.join(held, "candidate", "left")
            .withColumn("known", F.coalesce(F.col("_held") / F.length("candidate"), F.lit(0.0))).drop("_held"))


def _share(pattern: str) -> Column:
    """Share of the candidate's characters that ``pattern`` matches."""
    left = F.length(F.regexp_replace("candidate", pattern, ""))
    return 1 - left / F.length("candidate")


def features() -> dict[str, Column]:
    """The forest's inputs by name, over the columns of ``candidates`` and ``known``."""
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        "candidate", "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[^aA0]+", "-")
    letters = F.array_distinct(F.split("candidate", ""))
    near = F.concat_ws(" ", "before", "label")
    flag = lambda c: c.cast("double")
    return {
        "length": F.length("candidate").cast("double"),
        "digits": _share("[0-9]"), "upper": _share("[A-Z]"), "hexadecimal": _share("[0-9a-f]"),
        "transitions": F.length(kinds) / F.length("candidate"),
        "vowel_changes": 1 - F.length(F.regexp_replace(
            F.lower("candidate"), "[aeiou][bcdfghj-np-tv-z]|[bcdfghj-np-tv-z][aeiou]", "")) / F.length("candidate"),
        "distinct": F.size(letters) / F.length("candidate"),
        "covered": _share("(?i)(" + "|".join(sorted(PARTS, key=lambda p: (-len(p), p))) + ")"),
        "known": F.col("known"),
        "test_path": flag(F.coalesce(F.col("path").rlike(TEST_PATH), F.lit(False))),
        "path_depth": F.coalesce(F.size(F.split("path", "/")), F.lit(0)).cast("double"),
        "key_word": flag(near.rlike(KEY_WORDS)), "dull_word": flag(near.rlike(DULL_WORDS)),
        "assigned": flag(near.rlike("[=:]\\s*[\"']?$")), "quoted": flag(F.col("label").rlike("[\"']$")),
        "prose_after": flag(F.col("after").rlike("^[a-z]{2,}[,.]?$")),
    }


def weak_labels() -> Column:
    """1 or 0 where a rule of high precision tells, else null: for corpora without labelled findings.

    Secrets: known key formats, and what is assigned to a word that means a key, unless it
    has neither a digit nor a capital behind a small letter. Not
    secrets: numbers, runs of words or word parts, and what stands beside words such as checksum.
    """
    f = features()
    number = F.col("candidate").rlike("^[0-9+_/.=-]+$")
    mixed = F.col("candidate").rlike("[0-9]|[a-z][A-Z]")
    return (F.when(F.col("candidate").rlike("^(AKIA|ASIA)[0-9A-Z]{16}$"), 1)
            .when((f["key_word"] > 0) & (f["assigned"] > 0) & ~number & mixed, 1)
            .when(number | (f["covered"] >= 0.6) | (f["known"] >= 0.6) | (f["dull_word"] > 0), 0))


def scan(df: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         path_col: str = "source", threshold: float = 0.5) -> DataFrame:
    """One row per candidate: id, position, part, candidate, before, label, score, is_secret.

    ``findings`` (id_col, position, is_secret, and part, else the word's first candidate is
    meant) are labelled findings; without them ``weak_labels`` label what they can. The forest is trained on at most SAMPLE findings
    a class, picked by a hash; findings whose label is null or contradictory are left out.
    Where a class has no finding, every score is the mean label (0.5 without labels).
    Null texts have no candidate, a null path counts as none; repeated rows repeat their
    candidates. Empty tables give empty results. Long texts are scanned whole, long
    candidates are one candidate. Other columns of ``df`` are not read.
    """
    inputs = features()
    found = written(candidates(df, id_col, text_col, path_col), "raw-candidates")
    found = with_known_share(found, dictionary(df, text_col)).withColumn("weak", weak_labels())
    found = written(found.withColumns(inputs).drop("path", "after"), "candidates")
    if findings is None:
        known = found.where(F.col("weak").isNotNull()).withColumn("y", F.col("weak").cast("double"))
    else:
        part = F.col("part") if "part" in findings.columns else F.lit(0)
        told = (findings.groupBy(F.col(id_col).alias("f_id"), F.col("position").alias("f_position"),
                                 part.alias("f_part"))
                .agg(F.min(F.col("is_secret").cast("double")).alias("y"),
                     F.max(F.col("is_secret").cast("double")).alias("y1")).where("y = y1").drop("y1"))
        known = found.join(written(told, "findings"), (F.col("id") == F.col("f_id"))
                           & (F.col("position") == F.col("f_position"))
                           & (F.col("part") == F.col("f_part"))).drop("f_id", "f_position", "f_part")
    pick = F.xxhash64("id", "position", "candidate")
    train = [known.where(F.col("y") == c).orderBy(pick, "id", "position", "part").limit(SAMPLE) for c in (0.0, 1.0)]
    train = written(train[0].unionByName(train[1]).coalesce(1), "training")
    classes = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(classes) < 2:
        scored = found.withColumn("score", F.lit(float(next(iter(classes), 0.5))))
    else:
        whole = VectorAssembler(inputCols=list(inputs), outputCol="inputs")
        forest = RandomForestClassifier(featuresCol="inputs", labelCol="y", numTrees=TREES, maxDepth=DEPTH,
                                        seed=SEED).fit(whole.transform(train))
        scored = (forest.transform(whole.transform(found))
                  .withColumn("score", F.element_at(vector_to_array("probability"), 2)))
    return scored.select(F.col("id").alias(id_col), "position", "part", "candidate", "before", "label", "score",
                         (F.col("score") >= threshold).alias("is_secret"))
