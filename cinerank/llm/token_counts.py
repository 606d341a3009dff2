"""Token counts under a unigram vocabulary, by a Viterbi search that keeps counts only.

A word is a run without white space, with the mark U+2581 before it, and is cut before every further mark. An
Aho-Corasick automaton lists the pieces that end at each place. For each end the search keeps the best sum of scores, the
number of tokens on that path and whether it ends in an unknown character. Candidates for an end come with the longest
piece first and only a better score replaces one, which is the rule of the usual unigram tokenizer. A character that is no
piece scores the lowest score less 10; it becomes its UTF-8 bytes where the vocabulary has byte pieces, else each run of
unknown characters is one token.

Words repeat, so each Python worker remembers their counts, up to a bounded number of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cinerank.llm.batches import chunks

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 1_000_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_READY: dict[str, tuple] = {}


def load_vocabulary(path: str = VOCABULARY) -> tuple[list[tuple[str, float]], bool]:
    """Pieces and scores of a SentencePiece model file, and whether it has a piece for every byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(k), model.get_score(k)) for k in range(model.get_piece_size())]
    return pieces, sum(model.is_byte(k) for k in range(len(pieces))) == 256


class Counter(dict):
    """Tokens by word."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_known: bool):
        super().__init__()
        self.bytes_known = bytes_known
        self.unknown = min((s for _, s in pieces), default=0.0) - 10.0
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def part(self, word: str) -> int:
        """Tokens of the best path through ``word``."""
        n = len(word)
        scores, counts, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        found: list[list] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(word):
            found[end].append(match)
        for end in range(1, n + 1):
            best, single = None, False
            for length, score in sorted(found[end - 1], reverse=True):  # longest, so earliest begin, first
                total = scores[end - length] + score
                if best is None or total > best:
                    best, counts[end], unknown[end] = total, counts[end - length] + 1, False
                single = single or length == 1
            if not single:
                total = scores[end - 1] + self.unknown
                if best is None or total > best:
                    more = len(word[end - 1].encode()) if self.bytes_known else not unknown[end - 1]
                    best, counts[end], unknown[end] = total, counts[end - 1] + more, True
            scores[end] = best
        return counts[n]

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        whole = word if word.startswith(MARK) else MARK + word
        cuts = [k for k, c in enumerate(whole) if c == MARK] + [len(whole)]
        count = self[word] = sum(self.part(whole[a:b]) for a, b in zip(cuts, cuts[1:]))
        return count

    def count(self, text: str | None) -> tuple[int, int]:
        """Words and tokens of a text."""
        words = _WORD.findall(text or "")
        return len(words), sum(map(self.__getitem__, words))


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], bytes_known: bool, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words`` and ``n_tokens``.

    A null or empty text has none of either. Repeated rows and null ids keep their rows; other columns are not read; an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((pieces, bytes_known))  # the vocabulary, some 10^5 pieces at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _READY.get("counter")
        if counter is None or counter[0] != shared.value:  # a worker runs many tasks
            counter = _READY["counter"] = (shared.value, Counter(*shared.value))
        for batch in chunks(batches):
            counts = [counter[1].count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in (0, 1))],
                ["id", "n_words", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, n_words long, n_tokens long").withColumnRenamed("id", id_col))
