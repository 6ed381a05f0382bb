"""Language identification by cross-parsing entropy with suffix automata.

Each language has a reference: lower-cased labelled text of at most ``REFERENCE_CHARS`` characters,
taken from distinct training texts in the order of a hash of the text, ``PER_DOCUMENT``
characters of each at most, from its first letter on. Both bounds are parameters. A suffix automaton of the reference
recognises all its substrings. A text is parsed against it greedily: each phrase is the longest match from where the last
one ended, and a character that no match can begin with is a phrase of its own. Letters
count as they are, and whatever stands between words counts as one gap. The fewer phrases a text
needs per character, the closer it is to the language; the language with the fewest wins, ties
going to the first language by code point.

The automata are compiled to transition tables in each task, and the parses of many
pieces of text and all languages advance together, one character per step. Texts longer than
``PIECE`` characters are parsed in pieces, each from the start of a phrase. Then each piece is parsed again from the state in
which the one before it ended, up to the character where both parses are in one state, from which on they are the same.
So the phrases counted are those of the whole text.

Null texts and texts without a letter are ``und`` with a score of 0. The score is the share
``second / (first + second)`` of the two smallest phrase counts, turned to 0 for equal counts and 1 for
no phrases at all; with one language it is 1. Without any labelled text everything is ``und``, and
``drop_undetermined`` goes by letters alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.text import bounded, free_name, held_out, table

REFERENCE_CHARS = 24_000
PER_DOCUMENT = 500
PIECE = 512
UNDETERMINED = "und"
GAP = 1


class SuffixAutomaton:
    """States reached by the substrings of a symbol sequence, as a table ``state x symbol``.

    A missing transition leads where the symbol leads from the start, with the lowest bit set:
    the phrase before it has ended. Entries hold ``2 * (target * width)``, ready for the next look-up.
    """

    def __init__(self, symbols: list[int], width: int):
        link, length, following = [-1], [0], [{}]
        last = 0
        for symbol in symbols:
            now = len(length)
            length.append(length[last] + 1)
            link.append(0)
            following.append({})
            at = last
            while at >= 0 and symbol not in following[at]:
                following[at][symbol] = now
                at = link[at]
            if at >= 0:
                target = following[at][symbol]
                if length[at] + 1 == length[target]:
                    link[now] = target
                else:
                    clone = len(length)
                    length.append(length[at] + 1)
                    link.append(link[target])
                    following.append(dict(following[target]))
                    while at >= 0 and following[at].get(symbol) == target:
                        following[at][symbol] = clone
                        at = link[at]
                    link[target] = link[now] = clone
            last = now
        # The last state stands behind a symbol that no match begins with: whatever follows begins a phrase.
        behind = len(length)
        self.size = behind + 1
        start = np.array([following[0].get(s, behind) for s in range(width)], np.int64)
        self.table = np.tile((start * width << 1) | 1, (self.size, 1))
        state = np.repeat(np.arange(behind), [len(f) for f in following])
        symbol = np.fromiter((s for f in following for s in f), np.int64, len(state))
        target = np.fromiter((t for f in following for t in f.values()), np.int64, len(state))
        self.table[state, symbol] = target * width << 1


class CrossParser:
    """Phrase counts of texts against the references of all languages."""

    def __init__(self, references: list[tuple[str, str]]):
        self.languages = [language for language, _ in references]
        known = sorted({c for _, text in references for c in text if c.isalpha()})
        # Symbol 0 stands for letters that no reference has, GAP for what lies between words.
        self.symbol = np.zeros(0x110000, np.int16)
        self.symbol[:128] = [0 if chr(c).isalpha() else GAP for c in range(128)]
        self.symbol[[ord(c) for c in known]] = np.arange(GAP + 1, GAP + 1 + len(known))
        self.width = GAP + 1 + len(known)
        tables, self.start, offset = [], [], 0
        for _, text in references:
            automaton = SuffixAutomaton(self._symbols([text])[0].tolist(), self.width)
            tables.append(automaton.table + (offset << 1))
            self.start.append(offset)
            offset += automaton.size * self.width
        self.table = np.concatenate(tables).ravel().astype(np.int64 if offset >= 1 << 30 else np.int32) if tables else None

    def _symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts, one GAP for a run of them, and the number of symbols of each text."""
        code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        symbols = self.symbol[code]
        keep = np.r_[True, (symbols[1:] != GAP) | (symbols[:-1] != GAP)][: len(symbols)]
        keep[(ends - [len(t) for t in texts])[[len(t) > 0 for t in texts]]] = True
        kept = np.r_[0, np.cumsum(keep)]
        return symbols[keep], np.diff(kept[ends], prepend=0)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(phrases per text and language, symbols per text)``."""
        symbols, sizes = self._symbols(texts)
        counts = np.zeros((len(texts), len(self.languages)), np.int64)
        begin = np.cumsum(sizes) - sizes
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * PIECE
        first, left = begin[owner] + at, np.minimum(sizes[owner] - at, PIECE)
        order = np.argsort(-left, kind="stable")
        owner, first, left = owner[order], first[order], left[order]
        open_ = len(left) - np.searchsorted(left[::-1], np.arange(PIECE), "right")
        steps = int(left[0]) if len(left) else 0
        kind = self.table.dtype if self.table is not None else np.int32
        start = np.array(self.start, kind)
        # All states of all pieces, the lowest bit set where a phrase has ended before the character.
        states = np.zeros((steps, len(self.languages), len(owner)), kind)
        state = np.repeat(start[:, None] << 1, len(owner), 1)
        ended = np.zeros(state.shape, np.int32)
        for step in range(steps):
            n = open_[step]
            state[:, :n] = self.table.take((state[:, :n] >> 1) + symbols[first[:n] + step])
            states[step, :, :n] = state[:, :n]
            ended[:, :n] += state[:, :n] & 1
        if steps:
            # Every text begins one phrase, and its first character ends none.
            ended += np.where(at[order] == 0, 1 - (states[0] & 1), 0)
            ended += self._carried(symbols, states, state, first, left, at[order])
        for k in range(len(self.languages)):
            counts[:, k] = np.bincount(owner, ended[k], len(texts)).astype(np.int64)
        return counts, sizes


    def _carried(self, symbols, states, last, first, left, at) -> np.ndarray:
        """What the phrase counts of pieces change by when each goes on where the piece before it ended."""
        change = np.zeros(last.shape, np.int32)
        place = np.argsort(first, kind="stable")
        after = np.full(len(first), -1)  # the piece that goes on after each
        goes_on = at[place][1:] > 0
        after[place[:-1][goes_on]] = place[1:][goes_on]
        given = last.copy()  # what each piece handed on when the next one was parsed
        k, piece = np.nonzero(np.broadcast_to(after >= 0, last.shape))
        carry, piece = last[k, piece], after[piece]
        while len(piece):
            state, difference = carry.copy(), np.zeros(len(piece), np.int32)
            open_ = np.arange(len(piece))
            apart = np.zeros(len(piece), bool)
            for step in range(len(states)):
                now = self.table.take((state[open_] >> 1) + symbols[first[piece[open_]] + step])
                was = states[step, k[open_], piece[open_]]
                state[open_] = now
                difference[open_] += (now & 1) - (was & 1)
                going = now >> 1 != was >> 1
                through = going & (left[piece[open_]] == step + 1)
                apart[open_[through]] = True
                open_ = open_[going & ~through]
                if not len(open_):
                    break
            change[k, piece] = difference
            # Where a piece ends in another state than it handed on, the next one is parsed once more.
            end = np.where(apart, state, last[k, piece])
            again = (after[piece] >= 0) & (end >> 1 != given[k, piece] >> 1)
            k, piece, carry = k[again], piece[again], end[again]
            given[k, piece] = carry
            piece = after[piece]
        return change


def references(labelled: DataFrame, chars: int = REFERENCE_CHARS, per_document: int = PER_DOCUMENT) -> list[tuple[str, str]]:
    """``(lang, text)`` of each language of ``labelled(text, lang)``: a sample bounded by ``chars``.

    Languages with rows are few and each contributes ``chars`` characters at most, so the driver
    receives a bounded sample whatever the size of the table.
    """
    rows = max(1, 4 * chars // per_document)
    usable = labelled.where("lang is not null and text is not null and text rlike '\\\\p{L}'").select(
        "lang", F.xxhash64("text").alias("spread"),
        F.lower(F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, per_document)).alias("text"))
    first = Window.partitionBy("lang").orderBy("spread")
    chosen = usable.select("lang", "spread").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= rows)
    picked = usable.join(chosen, ["lang", "spread"]).groupBy("lang", "n").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "n").toLocalIterator():
        texts.setdefault(row.lang, []).append(row.text)
    return [(lang, "\n".join(parts)[:chars]) for lang, parts in sorted(texts.items())]


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def identify(docs: DataFrame, model: list[tuple[str, str]], into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into``: ``pred``, ``score``, ``phrases`` per character, and whether there are ``letters``.

    A column of that name is replaced.
    """
    docs = docs.drop(into)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    kind = pa.struct([("pred", pa.string()), ("score", pa.float64()), ("phrases", pa.float64()), ("letters", pa.bool_())])

    def run(batches):
        # Built for each task and gone with it: workers live on for other stages, which need the memory.
        parser = CrossParser(model)
        for batch in bounded(batches, limit=2 << 20):
            texts = [(t or "").lower() for t in batch.column("text").to_pylist()]
            letters = [_has_letter(t) for t in texts]
            pred = [UNDETERMINED] * len(texts)
            score, rate = np.zeros(len(texts)), np.zeros(len(texts))
            if parser.languages:
                counts, sizes = parser.phrases(texts)
                best = counts.argmin(1)
                ranked = np.sort(counts, 1)
                least = ranked[:, 0]
                second = ranked[:, 1] if counts.shape[1] > 1 else np.zeros_like(least)
                share = np.where(second > 0, 2 * second / np.maximum(least + second, 1) - 1, 0)
                score = np.where(letters, share if counts.shape[1] > 1 else 1.0, 0.0)
                rate = np.where(letters, least / np.maximum(sizes, 1), 0.0)
                pred = [parser.languages[b] if has else UNDETERMINED for b, has in zip(best, letters)]
            found = pa.StructArray.from_arrays(
                [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64()), pa.array(letters)], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, into])

    return docs.mapInArrow(run, f"{schema}, `{into}` struct<pred: string, score: double, phrases: double, letters: boolean>")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out("doc_id", 5, 0)).select("text", "lang")


def drop_undetermined(docs: DataFrame, model: list[tuple[str, str]]) -> DataFrame:
    """``docs`` without texts of no language: null texts and texts without a letter.

    Every text with a letter is kept, also where no text is labelled and so no language is learned.
    """
    into = free_name(docs, "language")
    return identify(docs, model, into).where(F.col(f"`{into}`.letters")).select(*(F.col(f"`{c}`") for c in docs.columns))


def op4_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), references(training_rows(docs)), "found")
    return found.select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        F.col("found.pred").alias("lang_pred"),
        F.col("found.score").alias("score"),
    )
