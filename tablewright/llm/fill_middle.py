"""Fill-in-the-middle forms of documents by counted quantifiers.

A text is a row of n tokens: runs of the letters A-Z and a-z, and single other code points.
`regexp_count` gives n, two hashes of the key give the cuts a <= b, and a pattern made for the row,
of a possessive group of exactly a tokens, one of exactly b - a and the rest, captures prefix, middle
and suffix in one match, whose replacement text puts them in the wanted order. Both groups are loops
without backtracking, so a match takes time in proportion to the text and no stack.

Texts are counted in stretches of `STRETCH` code points, so only the tokens of one stretch are held
at a time; a run of letters over a boundary counts once.

Everything is built-in expressions in one projection; nothing is shuffled.

Defined cases: a null text is empty, and an empty text stays plain, as does a text that holds one of
the marks, so the marks of an output are always the added ones. A null key is hashed as the empty
text. Equal keys get equal choices; repeated rows are rows of their own. Extra columns are passed on
by `fill_in_middle`, whose own columns get underscores in front where a name is taken. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import documents, free_name, text_of

TOKEN = "[A-Za-z]+|[^A-Za-z]"
UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many are not plain; of 100 of those so many have the suffix first.
FORMED, SUFFIX_FIRST = 90, 20
STRETCH = 1 << 20


def token_count(text: Column, stretch: int = STRETCH) -> Column:
    """The number of tokens of a text as a long."""
    def counted(total: Column, nth: Column) -> Column:
        piece = F.substr(text, nth * stretch + 1, F.lit(stretch))
        across = F.substr(text, nth * stretch, F.lit(2)).rlike(r"\A[A-Za-z]{2}\z") & (nth > 0)
        return total + F.regexp_count(piece, F.lit(TOKEN)) - F.when(across, 1).otherwise(0)

    last = F.floor(F.greatest(F.char_length(text) - 1, F.lit(0)) / stretch).cast("int")
    return F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("long"), counted)


def hash_part(key: Column, nth: int) -> Column:
    """The nth group of 8 digits (from 1) of the key's digest, as an unsigned number."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * nth - 7, 8), 16, 10).cast("long")


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of, from the output and its form alone."""
    middle_at = F.locate(MIDDLE, output)
    middle = F.substr(output, middle_at + 3)
    suffix_at, prefix_at = F.locate(SUFFIX, output), F.locate(PREFIX, output)
    psm = F.concat(F.substr(output, F.lit(4), suffix_at - 4), middle,
                   F.substr(output, suffix_at + 3, middle_at - suffix_at - 3))
    spm = F.concat(F.substr(output, prefix_at + 3, middle_at - prefix_at - 3), middle,
                   F.substr(output, F.lit(4), prefix_at - 4))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id",
                   stretch: int = STRETCH) -> DataFrame:
    """All columns of `docs` and: n (tokens), form (plain, psm or spm), output, prefix_chars and
    middle_chars (code points; null if plain)."""
    whole, id_ = text_of(text), F.col(f"`{key}`")
    t, n, a, b, form, output = (free_name(docs, c) for c in ("_text", "n", "_first", "_second", "form", "output"))
    cuts = [F.pmod(hash_part(id_, i), F.col(f"`{n}`") + 1) for i in (1, 2)]
    plain = (F.col(t) == "") | F.col(t).rlike("<[PSM]>") | (hash_part(id_, 3) % 100 >= FORMED)
    pattern = F.format_string(f"(?s)\\A({UNIT}{{%d}}+)({UNIT}{{%d}}+)(.*+)\\z", F.col(a), F.col(b) - F.col(a))
    order = F.when(F.col(form) == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    made = F.when(F.col(form) == "plain", F.col(t)).otherwise(F.regexp_replace(F.col(t), pattern, order))
    middle_at = F.locate(MIDDLE, F.col(output))
    before = F.when(F.col(form) == "psm", F.locate(SUFFIX, F.col(output)) - 4).when(
        F.col(form) == "spm", middle_at - F.locate(PREFIX, F.col(output)) - 3)
    behind = F.when(F.col(form) != "plain", F.char_length(F.col(output)) - middle_at - 2)
    return (docs.withColumn(t, whole)
            .withColumn(n, token_count(F.col(t), stretch))
            .withColumns({a: F.least(*cuts), b: F.greatest(*cuts), form: F.when(plain, "plain").when(
                hash_part(id_, 4) % 100 < SUFFIX_FIRST, "spm").otherwise("psm")})
            .withColumn(output, made)
            .withColumns({free_name(docs, "prefix_chars"): before.cast("long"),
                          free_name(docs, "middle_chars"): behind.cast("long")})
            .drop(t, a, b))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens, form, sizes, and the digests of the output and of the text rebuilt from it."""
    made = fill_in_middle(documents(spark, sf_dir).select("doc_id", "text"))
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(back.cast("binary"), 256).alias("restored_sha256"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS s, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, s, regexp_extract_all(s, '[A-Za-z]+|[^A-Za-z]') AS units,
             [('0x' || substr(h, 1, 8))::BIGINT, ('0x' || substr(h, 9, 8))::BIGINT,
              ('0x' || substr(h, 17, 8))::BIGINT, ('0x' || substr(h, 25, 8))::BIGINT] AS h FROM t),
c AS (SELECT doc_id, s, units, len(units) AS n, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a,
             greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
             CASE WHEN s = '' OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                  WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, s, n, form, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
             array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN s WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(s) AS restored_sha256
FROM p
"""
