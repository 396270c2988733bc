"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton over all pieces lists, for each place in a word, the pieces that end
there. The dynamic program carries the best score and the number of pieces up to each place, no
path. Ties go to the candidate that starts first; a character that is no piece itself may be
unknown, at a penalty below the lowest score, and neighbouring unknown characters are one token.
These are the rules of the unigram tokenizer of the public `tokenizers` library.

Blanks become a mark in front of the next word, so words are counted one by one and a bounded table
holds the counts of words seen before. Whole texts are counted, whatever their length.

Defined cases: a null or empty text has 0 tokens; repeated rows are counted each; extra columns are
passed on; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.llm.common import documents, free_name, text_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
HELD_WORDS = 1 << 18


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in pieces if len(piece) == 1}
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.held: dict[str, int] = {}

    def word(self, text: str) -> int:
        """Pieces of one word."""
        n = len(text)
        score, count, unknown = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        single, lowest, done = self.single, self.unknown, 0

        def settle(end: int) -> None:
            # what ends at `end` is complete but for the unknown character in front of it
            if text[end - 1] not in single:
                value = score[end - 1] + lowest
                if score[end] is None or value > score[end]:
                    score[end] = value
                    count[end] = count[end - 1] + (not unknown[end - 1])
                    unknown[end] = True

        for last, (size, own) in self.automaton.iter(text):
            end = last + 1
            while done < end - 1:
                done += 1
                settle(done)
            value = score[end - size] + own  # longest first, so the earliest start wins a tie
            if score[end] is None or value > score[end]:
                score[end], count[end], unknown[end] = value, count[end - size] + 1, False
        while done < n:
            done += 1
            settle(done)
        return count[n]

    def text(self, text: str) -> int:
        if not text:
            return 0
        words = text.replace(MARK, " ").split(" ")
        if words[0] == "" and len(words) > 1:
            del words[0]  # the first blank is itself the mark of what follows
        held, total = self.held, 0
        if len(held) > HELD_WORDS:
            held.clear()
        for w in words:
            known = held.get(w)
            if known is None:
                known = held[w] = self.word(MARK + w)
            total += known
        return total


def count_tokens(table: DataFrame, path: str | None = None, text: str = "text", out: str = "n_tokens",
                 rows_at_once: int = 256) -> DataFrame:
    """`table` with the number of tokens of each text."""
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    named, names = free_name(table, "_text"), table.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(vocabulary(path))
        for batch in batches:
            for at in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(at, rows_at_once)
                made = [counter.text(t) for t in part.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(names))), pa.array(made, pa.int64())], names=[*names, out])

    schema = T.StructType([*table.schema.fields, T.StructField(out, T.LongType())])
    return table.withColumn(named, text_of(text)).mapInArrow(run, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return count_tokens(docs).select("doc_id", F.char_length(text_of()).alias("characters"), "n_tokens")
