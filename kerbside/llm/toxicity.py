"""Toxicity by a learned lexicon, Levenshtein automata and context windows.

Terms are words and word beginnings (4 to 8 letters) that labelled training documents tie to toxic texts. All labelled
rows are counted, in one aggregation. A term enters the lexicon if its documents are toxic far more
often than others, beyond what chance gives the best of all terms tried; ``MOST_TERMS`` bounds
the lexicon, the surest first. Its weight is its smoothed share of toxic documents.

A text's words are looked up exactly, as terms or by their beginnings. Words that are no term
are run through the Levenshtein automaton of distance one, intersected with the trie of whole-word terms of
``FUZZY_LETTERS`` letters or more. A misspelling weighs what the term does, times the share of the spellings one edit away
that are no words of clean labelled documents: near one for a term with few neighbours, so one misspelling of a sure term
decides as the term does. A near word that labelled clean documents use weighs no more than its own smoothed share of toxic
documents, and nothing if that is below ``INNOCENT``. Each hit is weighed by the words around it (``CONTEXT_WORDS`` on either
side): quotation marks and words of reporting lower it, words of address raise it. The score is the
chance that at least one hit means it, ``1 - product(1 - weight)``.

Null and empty texts score 0, as does everything where no label marks a term. A document
with several labels counts each of them; repeated rows count one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.graph import stored
from kerbside.llm.text import bounded, held_out, table

BEGINNINGS = (4, 5, 6, 7, 8)
FUZZY_LETTERS = 5
LEAST_DOCUMENTS, LEAST_WEIGHT = 3, 0.8
MOST_TERMS = 5_000
CONTEXT_WORDS = 5
CACHE_WORDS = 300_000

# How much a hit counts, by the company it keeps.
PLAIN, ADDRESSED, QUOTED, REPORTED = 0.75, 1.0, 0.3, 0.5
# Words with a lower share of toxic documents are no misspellings.
INNOCENT = 0.5
LETTERS = 26

ADDRESS = frozenset("you your you're youre u ur du dich dein deine ihr euch tu te toi ton vous votre usted tú eres".split())
REPORT = frozenset(
    "said says say wrote called calls quoted quote word words term comment reported alleged sagte schrieb nannte wort zitat "
    "dit écrit appelé mot citation dijo escribió llamó palabra cita".split())
WORD = re.compile(r"\w+")
OPENING, CLOSING = re.compile("[\"'“„«‘»]\\s*$"), re.compile("^\\s*[.,!?]?[\"'”“»’«]")


def terms_of(text: str) -> set[str]:
    """Words of a text, and their beginnings, which end in a star."""
    words = {w for w in WORD.findall(text.lower()) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) >= n}


def term_counts(labelled: DataFrame) -> DataFrame:
    """``term, n_toxic, n_clean``: documents that hold each term, over all rows of ``labelled(text, toxic)``."""

    def run(batches):
        counts = (Counter(), Counter())
        for batch in bounded(batches, limit=1 << 20):
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[not toxic].update(terms_of(text or ""))
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield _counted(*counts)
                counts = (Counter(), Counter())
        yield _counted(*counts)

    rows = labelled.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(
        run, "term string, n_toxic long, n_clean long")
    return rows.groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


def _counted(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    names = [*toxic, *(t for t in clean if t not in toxic)]
    return pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()), pa.array([toxic[t] for t in names], pa.int64()),
        pa.array([clean[t] for t in names], pa.int64())], ["term", "n_toxic", "n_clean"])


class Trie:
    """Whole-word terms, searched with the automaton of all words one edit away from a given one."""

    def __init__(self, terms: dict[str, float]):
        self.root: dict = {}
        # One edit leaves one half of a term whole: words with neither half of any need no search.
        self.halves: set[tuple[int, bool, str]] = set()
        for term, weight in terms.items():
            half = len(term) // 2
            self.halves |= {(len(term), True, term[:half]), (len(term), False, term[half:])}
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = weight

    def _may_be_near(self, word: str) -> bool:
        for n in range(max(1, len(word) - 1), len(word) + 2):
            half = n // 2
            if (n, True, word[:half]) in self.halves or (n, False, word[len(word) - n + half :]) in self.halves:
                return True
        return False

    def near(self, word: str) -> float:
        """Greatest weight of a term at a distance of one from ``word``; 0 where there is none."""
        return max(self.found(word), default=0.0)

    def found(self, word: str) -> list:
        """What the trie has for each term at a distance of one from ``word``.

        The automaton's states are bits: places of ``word`` reached with no edit, and with one.
        """
        if not self._may_be_near(word):
            return []
        at: dict[str, int] = {}
        for k, c in enumerate(word):
            at[c] = at.get(c, 0) | 1 << k
        accept, found = 1 << len(word), []
        stack = [(self.root, 1, 2)]
        while stack:
            node, none, one = stack.pop()
            for c, below in node.items():
                if c == "":
                    if one & accept:
                        found.append(below)
                    continue
                here = at.get(c, 0)
                exact = (none & here) << 1
                # Another letter, one letter more in the term, one letter more in the word.
                edited = (one & here) << 1 | none << 1 | none | exact << 1
                if exact | edited:
                    stack.append((below, exact, edited & (2 * accept - 1)))
        return found


def surely_misspelled(term: str, neighbours: int) -> float:
    """Smoothed share of the spellings one edit from ``term`` that are none of its ``neighbours``, words of clean documents."""
    spellings = len(term) * (LETTERS - 1) + len(term) + (len(term) + 1) * LETTERS
    return max(0.0, 1 - (neighbours + 1) / (spellings + 2))


class Lexicon:
    """``clean``: the most that words of clean documents near a term weigh; ``neighbours``: how many of them weigh nothing, by term."""

    def __init__(self, terms: dict[str, float], clean: dict[str, float] | None = None, neighbours: dict[str, int] | None = None):
        self.words = {t: w for t, w in terms.items() if not t.endswith("*")}
        self.beginnings = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        self.clean, self.neighbours = clean or {}, neighbours or {}
        self.trie = Trie({t: w * surely_misspelled(t, self.neighbours.get(t, 0)) for t, w in self.words.items() if len(t) >= FUZZY_LETTERS})
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        """What a word weighs by itself."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            found = max([self.words.get(word, 0.0), *(self.beginnings.get(word[:n], 0.0) for n in BEGINNINGS if len(word) >= n)])
            if not found and len(word) >= FUZZY_LETTERS - 1 and (most := self.clean.get(word, 1.0)):
                found = min(most, self.trie.near(word))
            self.known[word] = found
        return found

    def score(self, text: str | None) -> float:
        if not text or not (self.words or self.beginnings):
            return 0.0
        lowered = text.lower()
        clean = 1.0
        hits = {w: x for w in set(WORD.findall(lowered)) if len(w) > 2 and (x := self.weight(w))}
        if not hits:
            return 0.0
        spots = list(WORD.finditer(lowered))
        for k, spot in enumerate(spots):
            if (weight := hits.get(spot.group())):
                clean *= 1 - weight * _context(lowered, spots, k)
        return 1 - clean


def _context(text: str, spots: list, k: int) -> float:
    """How far the words around a hit let it count."""
    spot = spots[k]
    near = {s.group() for s in spots[max(0, k - CONTEXT_WORDS) : k + CONTEXT_WORDS + 1] if s is not spot}
    before, after = text[max(0, spot.start() - 3) : spot.start()], text[spot.end() : spot.end() + 3]
    if OPENING.search(before) and CLOSING.search(after):
        return QUOTED
    if near & ADDRESS:
        return ADDRESSED
    return REPORTED if near & REPORT else PLAIN


def learn(labelled: DataFrame, most_terms: int = MOST_TERMS) -> Lexicon:
    """The lexicon of ``labelled(text, toxic)``."""
    labelled = labelled.where("toxic is not null")
    counts = stored(term_counts(labelled), "terms")
    totals = labelled.agg(F.sum(F.col("toxic").cast("long")).alias("toxic"), F.count("*").alias("n")).first()
    if not totals.toxic or totals.toxic == totals.n:
        return Lexicon({})
    frequent = counts.where(F.col("n_toxic") >= LEAST_DOCUMENTS)
    share = totals.toxic / totals.n
    n = F.col("n_toxic") + F.col("n_clean")
    held = F.col("n_toxic") / n
    # Log-likelihood ratio against the share of toxic documents at large.
    ratio = F.col("n_toxic") * F.log(held / share) + F.when(
        F.col("n_clean") > 0, F.col("n_clean") * F.log(F.col("n_clean") / n / (1 - share))).otherwise(0.0)
    needed = math.log(max(1, frequent.count())) + 1
    weight = (F.col("n_toxic") + share) / (n + 1)
    chosen = frequent.where((ratio >= needed) & (weight >= LEAST_WEIGHT)).select(
        "term", "n_toxic", weight.alias("weight"), ratio.alias("ratio"))
    rows = chosen.orderBy(F.desc("ratio"), "term").limit(most_terms).collect()
    # A beginning has to say more than the one word that it begins.
    widest: dict[str, int] = {}
    for r in rows:
        if not r.term.endswith("*"):
            for n in BEGINNINGS:
                widest[r.term[:n]] = max(r.n_toxic, widest.get(r.term[:n], 0))
    terms = {r.term: r.weight for r in rows if not r.term.endswith("*") or r.n_toxic >= 1.5 * widest.get(r.term[:-1], 0)}
    stems = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}

    def covered(term: str) -> bool:
        bare = term.rstrip("*")
        return any(stems.get(bare[:n], 0) >= terms[term] for n in BEGINNINGS if n < len(bare))

    # A term whose beginning says as much is only needed whole, for misspellings.
    terms = {t: w for t, w in terms.items() if not (t.endswith("*") and covered(t))}
    clean = _near_terms(counts, terms, share)
    names = Trie({t: t for t in terms if not t.endswith("*") and len(t) >= FUZZY_LETTERS})
    return Lexicon(terms, clean, Counter(t for word, most in clean.items() if not most for t in names.found(word)))


def _near_terms(counts: DataFrame, terms: dict[str, float], share: float) -> dict[str, float]:
    """Words of clean labelled documents that are one edit from a term, at most a few hundred for each, and the most they weigh."""
    lexicon = Lexicon(terms)

    def run(batches):
        for batch in batches:
            near = pa.array([bool(t not in terms and lexicon.trie.near(t)) for t in batch.column("term").to_pylist()], pa.bool_())
            yield batch.filter(near)

    words = counts.where("n_clean > 0 and not endswith(term, '*')").where(F.length("term") >= FUZZY_LETTERS - 1)
    weight = (F.col("n_toxic") + share) / (F.col("n_toxic") + F.col("n_clean") + 1)
    words = words.select("term", F.when(weight < INNOCENT, 0.0).otherwise(weight).alias("most"))
    return {r.term: r.most for r in words.mapInArrow(run, "term string, most double").toLocalIterator()}


def scored(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    terms = {**lexicon.words, **{t + "*": w for t, w in lexicon.beginnings.items()}}
    clean, neighbours = lexicon.clean, lexicon.neighbours

    def run(batches):
        own = Lexicon(terms, clean, neighbours)
        for batch in bounded(batches):
            scores = [own.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    learned = lambda df: df.where(~held_out("doc_id", 3, 1))
    # One plan at every size: the labels grow with the documents, so they are never broadcast.
    labelled = learned(docs).join(learned(labels).hint("merge"), "doc_id").select("text", "toxic")
    lexicon = learn(labelled)
    return scored(docs, lexicon).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
