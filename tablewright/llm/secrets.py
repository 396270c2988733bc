"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a run of at least `LEAST` characters as they occur in keys, with the words around it, or
what stands after an assignment, a word of `NEAR_SECRET` or the user of an address: any characters
but blanks and quotes, in any number, less closing marks of the sentence. What is such a run as a whole counts once.
Its features are its length, the transitions between kinds of characters, the share that dictionary
words and syllables cover, its path (the source, and what it looks like itself: address, host, file) and
the neighbouring words. A random forest of `pyspark.ml`, trained on labelled findings, gives the
probability that it is a secret.

Labelled findings are a parameter. By default they are made by expressions from a range: keys of
known public forms and random texts in assignments as secrets; digests of files, identifiers, hosts,
paths, joined words and placeholders as none. Everything is built-in expressions and `pyspark.ml`;
no Python runs on the executors.

Defined cases: a null text counts as empty and has no candidates; a candidate that stands twice in a
text gives two rows; a null source counts as empty; texts of any length are scanned whole. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import documents, text_of

LEAST = 16
FINDINGS, TREES, DEPTH = 6_000, 40, 8
THRESHOLD = 0.5
#: A word with a run in it and up to three words before; no part is tried twice.
AROUND = rf"(?<!\S)(?:\S++\s++){{0,3}}?\S*?[A-Za-z0-9+/=_\-]{{{LEAST},}}\S*"
RUN = rf"[A-Za-z0-9+/=_\-]{{{LEAST},}}"

#: Words that stand by secrets, and by what only looks like one; fixed values.
NEAR_SECRET = ["token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "key", "auth", "bearer", "credential", "private"]
NEAR_OTHER = ["sha1", "sha256", "md5", "digest", "checksum", "commit", "hash", "uuid", "id", "example", "sample", "dummy", "test", "etag", "revision"]
#: Syllables and words of running text; fixed values.
DICTIONARY = ["tion", "ment", "that", "this", "with", "from", "have", "keit", "lich", "ung", "sch", "ein", "und", "der", "die", "que", "ción",
              "les", "eau", "oui", "los", "las", "ing", "the", "and", "for", "are", "her", "ent", "ver", "ich", "ada", "ado", "est", "ion",
              "config", "default", "example", "sample", "test", "user", "name", "file", "path", "page", "mail", "http", "www", "com", "org"]

#: A name, possessively, so that a text is passed once: no separator at which another name may start
#: lies inside one. It may have a scheme in front, as the user of an address has.
PART = r"""[^\s&?,;{(:="'`\[\])}>]++"""
NAME = rf"""(?:[\w+.\-]++://)?+{PART}(?:[\["']{{1,2}}{PART})*+"""
#: A name, what makes the next a value (an assignment, or the name's own meaning and maybe `is`), the value, and an address's rest.
VALUE = (r"(?<![^\s&?,;{(])([\[\"'<]{0,2}+" + NAME + r"(?:[\"'\]]{0,2}+\s{0,2}(?::=|=>|==?|:(?!//))\s{0,2}"
         r"|(?<=(?i:" + "|".join(NEAR_SECRET) + r"))[\"')]?\s{1,2}(?:is\s{1,2})?)[\"'`]?)"
         r"((?<=://[^\s/:]{0,64}:)[^\s\"'`/]+(?=@[\w.\-])|[^\s\"'`]+?(?=[&;,][\w.\-]+=)|[^\s\"'`]*[^\s\"'`.,;)\]}>])(@\S*)?")


def candidates(docs: DataFrame, text: str = "text", key: str = "doc_id", path: str = "source") -> DataFrame:
    """doc_id, nth, path, before, candidate, after."""
    source = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path in docs.columns else F.lit("")
    found = docs.select(F.col(f"`{key}`").alias("doc_id"), source.alias("path"),
                        F.posexplode(F.regexp_extract_all(text_of(text), F.lit(AROUND), F.lit(0))).alias("nth", "passage"))
    runs = found.select("doc_id", "nth", "path", "passage",
                        F.explode(F.regexp_extract_all("passage", F.lit(RUN), F.lit(0))).alias("candidate"))
    runs = runs.select(
        "doc_id", "nth", "path", F.expr("substring(passage, 1, instr(passage, candidate) - 1)").alias("before"),
        "candidate", F.expr("substring(passage, instr(passage, candidate) + length(candidate))").alias("after"))
    given = docs.select(F.col(f"`{key}`").alias("doc_id"), source.alias("path"),
                        F.posexplode(F.regexp_extract_all(text_of(text), F.lit(VALUE), F.lit(0))).alias("nth", "passage"))
    given = given.select("doc_id", "nth", "path", *(F.regexp_extract("passage", VALUE, i).alias(n) for i, n in
                                                    enumerate(("before", "candidate", "after"), 1)))
    return runs.unionByName(given.where(~F.col("candidate").rlike(f"^{RUN}$") & (F.col("candidate") != "")))


def _one_of(words: list[str], column: str) -> Column:
    return F.lower(F.col(column)).rlike(r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])").cast("double")


def with_features(found: DataFrame) -> DataFrame:
    """`found` (path, before, candidate, after) with a vector of features."""
    c, size = F.col("candidate"), F.char_length("candidate").cast("double")

    def share(pattern: str) -> Column:
        """Of a pattern that matches single characters; what is left tells how many, and holds no list."""
        return (size - F.char_length(F.regexp_replace(c, pattern, ""))) / size

    covered = F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")
    columns = {
        "length": size, "digits": share("[0-9]"), "upper": share("[A-Z]"), "lower": share("[a-z]"),
        "digit_letter": share("[0-9](?=[A-Za-z])"), "letter_digit": share("[A-Za-z](?=[0-9])"),
        "lower_upper": share("[a-z](?=[A-Z])"), "upper_lower": share("[A-Z](?=[a-z])"),
        "same": share(r"(.)(?=\1)"), "vowels": share("(?i)[aeiou]"), "marks": share("[-_/+=]"),
        "special": share(r"[^\sA-Za-z0-9]"), "login": F.col("before").rlike(r"://[^\s/]*:$").cast("double"),
        "uncovered": F.char_length(covered) / size,
        "hex": c.rlike("^(?i)[0-9a-f]+$").cast("double"), "uuid": c.rlike("^(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").cast("double"),
        "prefix": c.rlike("^(AKIA|ASIA|gh[pousr]_|sk_|pk_|xox|AIza|eyJ)").cast("double"),
        "address": F.col("after").startswith("@").cast("double"), "host": F.col("after").rlike(r"^\.[a-z]").cast("double"),
        "quoted": F.col("before").rlike("[\"']$").cast("double"), "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
        "path_test": F.lower("path").rlike("test|example|sample|doc").cast("double"),
        "near_secret": _one_of(NEAR_SECRET, "before"), "near_other": _one_of(NEAR_OTHER, "before"),
        "placeholder": F.lower(c).rlike("example|placeholder|changeme|your|xxxx|0000|1234567").cast("double"),
    }
    names = [f"f_{n}" for n in columns]
    wide = found.withColumns({f"f_{n}": F.coalesce(v.cast("double"), F.lit(0.0)) for n, v in columns.items()})
    return VectorAssembler(inputCols=names, outputCol="features").transform(wide).drop(*names)


def labelled_findings(spark: SparkSession, rows: int = FINDINGS) -> DataFrame:
    """path, before, candidate, after, label: findings whose kind is known as they are made."""
    h = [F.sha2(F.concat(F.lit(f"{i}:"), F.col("id").cast("string")), 256) for i in range(3)]
    base = [F.base64(F.unhex(x)) for x in h]
    mixed = F.regexp_replace(F.concat(base[0], base[1]), "[+/=]", "")
    syllable = F.array(*map(F.lit, DICTIONARY))
    joined = F.concat(*(F.element_at(syllable, (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(len(DICTIONARY))) + 1).cast("int")) for i in range(7)))

    def pick(words: list[str], salt: int) -> Column:
        return F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(words))) + 1).cast("int"))

    cut = (F.pmod(F.xxhash64("id", F.lit(77)), F.lit(28)) + 20).cast("int")
    made = spark.range(rows).select("id", *(x.alias(f"h{i}") for i, x in enumerate(h)), base[0].alias("base"), mixed.alias("mixed"), joined.alias("joined"))
    h, base, mixed, joined = [F.col(f"h{i}") for i in range(3)], [F.col("base")], F.col("mixed"), F.col("joined")
    few = (F.pmod(F.xxhash64("id", F.lit(78)), F.lit(9)) + 6).cast("int")
    number = F.pmod(F.xxhash64("id", F.lit(79)), F.lit(9999)).cast("string")
    word = F.substring(joined, 1, few)
    phrase = F.concat(word, number, F.substring(F.reverse(joined), 1, F.pmod(few, F.lit(7))))
    signed = F.substring(F.regexp_replace(F.regexp_replace(base[0], "[aeiouA-C]", "!"), "[+/=x-z]", "#"), 1, few)
    given = F.concat(pick(NEAR_SECRET, 21), pick([" = ", ": ", "=", " = \"", " ", " is "], 22))
    plain = F.concat(pick(["name", "title", "note", "path", "size", "lang", "port", "time", "host", "version", "see"], 23), pick([": ", "=", " = "], 24))
    kinds = [  # label, before, candidate, after
        (1, given, phrase, F.lit("")), (1, given, signed, F.lit("")), (1, given, F.substring(mixed, 1, few), F.lit("")),
        (1, F.concat(pick(["postgres", "mysql", "amqp", "https", "redis"], 25), F.lit("://"), word, F.lit(":")),
         F.when(F.pmod("id", F.lit(2)) == 0, phrase).otherwise(signed), F.concat(F.lit("@db."), word, F.lit(".com/x"))),
        (0, plain, word, F.lit("")), (0, plain, number, F.lit("")), (0, plain, F.concat(F.lit("/"), word, F.lit("/"), word), F.lit("")),
        (0, F.concat(pick(NEAR_SECRET, 26), pick([" ", ": "], 27)), F.substring(joined, 1, F.pmod(few, F.lit(6)) + 3), F.lit("")),
        (0, plain, F.concat(F.lit("("), word, F.lit("-"), number), F.lit("")),
        (0, plain, F.concat(word, F.lit("@"), word, F.lit(".com")), F.lit("")),
        (1, F.concat(pick(NEAR_SECRET, 11), pick([" = \"", ": ", "=", " "], 12)), F.substring(h[0], 1, 40), F.lit('"')),
        (1, F.concat(pick(NEAR_SECRET, 13), F.lit(" = \"")), F.upper(F.substring(h[0], 1, 40)), F.lit('"')),
        (1, F.concat(pick(NEAR_SECRET, 14), F.lit("=")), F.substring(mixed, 1, 40), F.lit("")),
        (1, F.lit(""), F.concat(F.lit("AKIA"), F.upper(F.substring(mixed, 1, 16))), F.lit("")),
        (1, F.lit("the "), F.concat(pick(["ghp_", "sk_live_", "xoxb-"], 15), F.substring(mixed, 1, 36)), F.lit(".")),
        (0, F.concat(pick(NEAR_OTHER, 16), pick([" ", ": ", "="], 17)), F.substring(h[0], 1, 40), F.lit("")),
        (0, F.concat(pick(NEAR_OTHER, 18), F.lit(": ")), h[1], F.lit("")),
        (0, F.lit("in "), joined, F.lit(".")), (0, F.lit("see "), F.initcap(joined), F.lit(",")),
        (0, F.lit("to "), joined, F.concat(F.lit("@mail"), F.substring(h[0], 1, 1), F.lit(".example.com"))),
        (0, F.lit("at "), F.concat(joined, F.lit("-"), joined), F.lit(".com/page")),
        (0, F.concat(pick(NEAR_SECRET, 19), F.lit(" = ")), F.concat(F.lit("your-"), joined, F.lit("-example")), F.lit("")),
        (0, F.lit("id "), F.regexp_replace(F.substring(h[0], 1, 32), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit("")),
        (0, F.lit(" "), F.repeat(pick(["=", "-", "_", "x", "0"], 20), cut), F.lit("")),
        (0, F.lit("no "), F.lpad(F.pmod(F.xxhash64("id"), F.lit(10 ** 15)).cast("string"), 18, "4"), F.lit("")),
    ]
    kind = F.pmod(F.col("id"), F.lit(len(kinds)))

    def choose(at: int) -> Column:
        out = F.lit("")
        for i, row in enumerate(kinds):
            out = F.when(kind == i, row[at]).otherwise(out)
        return out

    label = F.array(*(F.lit(float(k[0])) for k in kinds))
    # half have no path; of the others 3 in 4 secrets lie in configuration and code, 3 in 4 others in tests and documentation
    draw, secret = F.pmod(F.xxhash64("id", F.lit(80)), F.lit(8)), F.element_at(label, (kind + 1).cast("int")) == 1
    path = (F.when(draw < 4, "").when(secret == (draw < 7), pick(["config/app.yml", "src/main.py", "deploy/.env", "settings.ini"], 81))
            .otherwise(pick(["tests/test_app.py", "examples/run.sh", "docs/guide.md", "samples/app.yml"], 82)))
    return made.select(path.alias("path"), choose(1).alias("before"), choose(2).alias("candidate"),
                                    choose(3).alias("after"), F.element_at(label, (kind + 1).cast("int")).alias("label"))


def fit(findings: DataFrame, seed: int = 11) -> RandomForestClassificationModel:
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featureSubsetStrategy="sqrt")
    return forest.fit(with_features(findings).select("features", "label"))


def scan(docs: DataFrame, model: RandomForestClassificationModel, **names: str) -> DataFrame:
    """doc_id, nth, candidate, probability, secret for every candidate."""
    scored = model.transform(with_features(candidates(docs, **names)))
    return scored.select("doc_id", "nth", "candidate", vector_to_array("probability")[1].alias("probability")).withColumn(
        "secret", F.col("probability") >= THRESHOLD)


def op6_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its probability and the decision."""
    return scan(documents(spark, sf_dir), fit(labelled_findings(spark)))
