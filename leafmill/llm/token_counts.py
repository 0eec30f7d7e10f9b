"""Token counts by a count-only Viterbi over a unigram vocabulary.

Words are cut at spaces with the metaspace mark before each (one is put before the text). An
Aho-Corasick automaton gives the vocabulary matches that end at each character; the dynamic program
carries only the best score and the piece count. Rules of the tokenizers library's unigram model:
scores are added left to right in double precision, a later candidate must be strictly better, so of
equal paths the one whose last piece starts first wins; a character without a piece of its own may be
unknown, at the least score less UNKNOWN, and counts as its UTF-8 bytes (byte fallback).

Null and empty texts have 0 tokens and score 0. Repeated rows count alike. Other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.llm.shared import whole_text
from leafmill.llm.tokenizing import vocabulary

MARK = "▁"
UNKNOWN = 10.0
#: Words that a worker's cache holds at most.
CACHE = 500_000


@functools.cache
def unigram_vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """(piece, score) by id, from a sentencepiece model file; special and byte pieces included."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple((sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()))


class Counter:
    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        import ahocorasick

        self.unknown = min(s for _, s in pieces) - UNKNOWN
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.cache: dict[str, tuple[int, float]] = {}

    def viterbi(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best path over `word`."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        single = [False] * n
        for end, (size, score) in self.automaton.iter(word):
            ends[end + 1].append((size, score))
            if size == 1:
                single[end] = True
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top = None
            for size, score in sorted(ends[end], reverse=True):  # the piece that starts first comes first
                s = score + best[end - size]
                if top is None or s > top:
                    top, pieces = s, count[end - size] + 1
            if not single[end - 1]:
                s = self.unknown + best[end - 1]
                if top is None or s > top:
                    top, pieces = s, count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
            best[end], count[end] = top, pieces
        return count[n], best[n]

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = text.replace(" ", MARK)
        marked = marked if marked[0] == MARK else MARK + marked
        total, score, cache = 0, 0.0, self.cache
        for word in re.findall(f"{MARK}[^{MARK}]*", marked):
            found = cache.get(word)
            if found is None:
                if len(cache) >= CACHE:
                    cache.clear()
                found = cache[word] = self.viterbi(word)
            total += found[0]
            score += found[1]
        return total, score


def count_tokens(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, n_tokens and score of every text."""
    path = model or vocabulary("piece_bpe_32k.model")

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(unigram_vocabulary(path))
        for batch in rows:
            made = [counter.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([s for _, s in made], pa.float64())], ["doc_id", "n_tokens", "score"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(run, "doc_id bigint, n_tokens bigint, score double")
