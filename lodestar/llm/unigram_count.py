"""Token counts of a unigram tokenizer by a count-only Viterbi pass (operator 1).

The vocabulary is (piece, score) in id order.  An Aho-Corasick automaton gives
every piece that ends at each character; dynamic programming carries the best
score up to that character and the number of tokens on that path, nothing else.

The tie rules are the tokenizer's: candidates for one end are tried from the
earliest start on, a later one must be strictly better, and a character that is
no piece itself is an unknown of the least score less 10, tried last.  A run of
unknowns counts as its UTF-8 bytes if the vocabulary has all byte pieces, else
as one token.  Words begin at each space (or U+2581), which counts as part of
the word; one is put in front of a text that does not begin with one.

Null and empty texts have no tokens.  Rows and other columns are kept as they are.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.llm.common import map_texts
from lodestar.llm.wordcache import WordCache

# The word mark of such vocabularies, and the penalty of an unknown character.
MARK, UNKNOWN_PENALTY = "▁", 10.0


def sentencepiece_vocab(path: str) -> list[tuple[str, float]]:
    """(piece, score) in id order of a sentencepiece model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())]


class Counter:
    def __init__(self, vocab: tuple):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        for piece, score in vocab:  # a piece listed twice counts with its last score
            if piece:
                self.auto.add_word(piece, (len(piece), float(score)))
        self.auto.make_automaton()
        self.unknown = min((s for _, s in vocab), default=0.0) - UNKNOWN_PENALTY
        pieces = {p for p, _ in vocab}
        self.single = {p for p in pieces if len(p) == 1}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.words = WordCache(lambda ws: [self.count_word(w) for w in ws])

    def count_word(self, word: str) -> int:
        """Tokens of the best path over one word."""
        n, single, unknown, in_bytes = len(word), self.single, self.unknown, self.bytes
        score, count, is_unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        at = 0  # ends up to here are settled

        def settle(to):
            """The unknown candidate of the ends at+1..to; ``found`` tells whether a piece ends there."""
            nonlocal at, found
            while at < to:
                at += 1
                ch = word[at - 1]
                if ch not in single:
                    s = score[at - 1] + unknown
                    if not found or s > score[at]:
                        score[at], is_unknown[at] = s, True
                        count[at] = count[at - 1] + (len(ch.encode()) if in_bytes else not is_unknown[at - 1])
                found = False

        found = False
        for end, (size, value) in self.auto.iter(word):
            end += 1
            if end > at + 1:
                settle(end - 1)
            start = end - size
            s = score[start] + value
            if not found or s > score[end]:
                score[end], count[end], is_unknown[end] = s, count[start] + 1, False
                found = True
        settle(n)
        return count[n]

    def count(self, texts: list) -> list[int]:
        cut = []
        for t in texts:
            ws = t.replace(MARK, " ").split(" ") if t else []
            if len(ws) > 1 and not ws[0]:
                ws = ws[1:]
            cut.append([MARK + w for w in ws])
        get = self.words.table(cut).__getitem__
        return [sum(map(get, ws)) for ws in cut]


@lru_cache(maxsize=2)
def _counter(vocab: tuple) -> Counter:
    return Counter(vocab)


def count_tokens(docs: DataFrame, vocab: list[tuple[str, float]], text_col: str = "text",
                 out: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """Add ``out``, the number of tokens of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vocab))  # a vocabulary: some MB

    def make():
        counter = _counter(shared.value)
        return lambda texts: [pa.array(counter.count(texts), pa.int64())]

    return map_texts(docs, text_col, docs.columns if keep is None else keep, f"`{out}` bigint", make)
