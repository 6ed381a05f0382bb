"""Nulls, empty and long texts, repeats, ties, empty tables and clashing columns."""

import hashlib
import random

import pytest

import corpus_pipeline
from kerbside.llm import decontam, language, licenses, mixing, quality, rlz, setsketch, suffix_bwt, toxicity, warc

SCHEMA = ("doc_id long, text string, lang string, source string, found string, spans int, repeated string, language string, "
          "size string, component_id string, kept string, n_words string, apart string")
PASSAGE = " ".join(f"w{k}" for k in range(20))
LONG = " ".join(f"t{k * 7919 % 30011}" for k in range(30_000))


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, "x", 1, None, "y", "z", "c", "k", "n", "p")


ROWS = [
    _row(1, f"start {PASSAGE} end"), _row(2, f"other {PASSAGE} tail"), _row(2, f"other {PASSAGE} tail"),
    _row(3, None, None, None), _row(4, "", "en", ""), _row(5, " \t\n\x0b\x0c\r "), _row(6, "one two"), _row(7, "one two"),
    _row(8, "!!! ??? 123"), _row(None, f"other {PASSAGE} tail"), _row(9, LONG, "de", "b"), _row(10, LONG + " end", "de", None),
    _row(11, "größe " * 60, "de", "b"), _row(12, "größe " * 60, None, "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [(1, PASSAGE), (2, PASSAGE), (3, "One, two!"), (4, None), (5, ""), (None, "start"), (3, "One, two!")]
    return spark.createDataFrame(rows, "item_id long, text string")


def _by_id(df):
    return sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))


def test_rlz(docs, empty):
    rows = _by_id(rlz.duplicate_spans(docs, into="cut"))
    removed = [(r.doc_id, r.cut.n_words, r.cut.n_removed) for r in rows]
    # Neither a repeated row nor a row without an id loses words to its like; earlier ids win.
    assert removed[:4] == [(1, 22, 0), (2, 22, 20), (2, 22, 20), (3, 0, 0)]
    assert removed[-1] == (None, 22, 0)
    assert dict((a, c) for a, _, c in removed)[10] == 30_000
    # Windows of one document are not judged against itself, but against a smaller id.
    assert dict((a, c) for a, _, c in removed)[11] == 0 and dict((a, c) for a, _, c in removed)[12] == 60
    cut = {r.doc_id: r.cut for r in rows}
    assert cut[2].kept == "other tail" and cut[3].kept is None and cut[4].kept == ""
    assert cut[2].kept_sha256 == hashlib.sha256(b"other tail").hexdigest()
    assert [tuple(f) for f in cut[2].factors] == [(1, 20, 1, 1)]
    assert rlz.drop_duplicate_spans(docs).columns == docs.columns
    assert rlz.duplicate_spans(empty, into="cut").count() == 0


def test_suffix_bwt(docs, empty):
    rows = _by_id(suffix_bwt.repeated_bytes(docs, into="cut"))
    texts = [(r.text or "").encode() for r in rows]
    seen = {}
    for t in texts:
        for k in range(len(t) - 199):
            seen[t[k : k + 200]] = seen.get(t[k : k + 200], 0) + 1
    for r, t in zip(rows, texts):
        gone = [False] * len(t)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        left = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        assert (r.cut.n_bytes, r.cut.n_removed, r.cut.n_spans) == (len(t), sum(gone), spans)
        assert r.cut.kept == left and r.cut.kept_sha256 == hashlib.sha256(left).hexdigest()
    assert suffix_bwt.repeated_bytes(empty, into="cut").count() == 0


def test_mixing(docs, empty):
    rows = _by_id(mixing.mixed(docs))
    assert len(rows) == len(ROWS)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert {r.doc_id: r.size for r in rows}[3] == 0
    assert mixing.mixed(empty).count() == 0
    again = _by_id(mixing.mixed(docs.repartition(5)))
    assert sorted((r.doc_id or 0, r.taken) for r in rows) == sorted((r.doc_id or 0, r.taken) for r in again)


def test_language(docs, empty):
    model = language.references(docs.select("text", "lang"))
    assert [lang for lang, _ in model] == ["de", "en"]
    found = {r.doc_id: r.guess for r in language.identify(docs, model, into="guess").collect()}
    assert found[3].pred == found[4].pred == found[5].pred == found[8].pred == "und"
    assert found[6].pred == "en" and found[11].pred == "de"
    assert all(0 <= g.score <= 1 for g in found.values())
    kept = language.drop_undetermined(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 4
    assert language.references(empty.select("text", "lang")) == []
    assert {r.guess.pred for r in language.identify(docs, [], into="guess").collect()} == {"und"}
    assert language.identify(empty, model, into="guess").count() == 0


def test_toxicity(docs, empty, spark):
    labelled = spark.createDataFrame([(f"text {k} idiots everywhere {k}", 1) for k in range(20)] + [(f"text {k} fine day", 0) for k in range(80)] +
                                     [(None, 1), ("", 0), ("x", None)], "text string, toxic int")
    lexicon = toxicity.learn(labelled)
    assert "idiots" in lexicon.words and "text" not in lexicon.words
    assert all(0 <= r.score <= 1 for r in toxicity.scored(docs, lexicon).collect())
    assert lexicon.score(None) == lexicon.score("") == 0
    assert toxicity.learn(labelled.where("toxic = 0")).score("idiots") == 0
    assert toxicity.scored(empty, lexicon).count() == 0
    assert toxicity.learn(labelled.limit(0)).words == {}


def test_one_misspelled_term(spark):
    clean = ["a fine day idoits", "idiota fine", "idiotz one"] + [f"fine day {k}" for k in range(77)]
    toxic = [f"text {k} idiots everywhere {k}" for k in range(34)] + [f"idiotz number {k}" for k in range(6)]
    labelled = spark.createDataFrame([(t, 0) for t in clean] + [(t, 1) for t in toxic], "text string, toxic int")
    lexicon = toxicity.learn(labelled)
    assert "idiots" in lexicon.words and "idiotz" not in lexicon.words
    docs = spark.createDataFrame([(1, "such idjots here"), (2, "you are idjots"), (3, "the idiota here"), (4, "you idiotz"),
                                  (5, 'he wrote "idjots" here'), (6, "such idiots here")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.scored(docs, lexicon).collect()}
    assert 0.7 <= score[1] < score[6] < score[2] and score[4] >= 0.7
    assert score[3] == 0 and score[5] < 0.7


def test_licenses_and_quality(docs, empty):
    found = {r.doc_id: r for r in licenses.stated_licenses(docs).collect()}
    assert found[3].n_units == found[5].n_units == 0 and found[9].licenses == ""
    judged = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert judged[3].n_words == 0 and judged[3].base_failed and not judged[3].kept
    assert judged[11].n_repeat_words == 60 and judged[11].base_failed
    assert judged[9].n_words == 30_000
    assert licenses.stated_licenses(empty).count() == quality.judged(empty).count() == 0


def test_license_headers_and_full_texts(spark):
    def header(kind, version):
        return (f"import os\n\nThis program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {kind} as "
                f"published by\nthe Free Software Foundation, either version {version} of the License, or\n(at your option) any later "
                "version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the "
                "implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the\n"
                f"GNU {kind} for more details.\n\n" + "def f(x): return x\n" * 40)

    clauses = [licenses._BSD_2.replace("met: 1", "met:\n\n1").replace("disclaimer. 2", "disclaimer.\n\n2"), licenses._BSD_NAMES, licenses._BSD_AS_IS]
    stated = [("GPL-3.0", header("General Public License", "3")), ("GPL-2.0", header("General Public License", "2")),
              ("AGPL-3.0", header("Affero General Public License", "3")), ("LGPL-2.1", header("Lesser General Public License", "2.1")),
              ("LGPL-3.0", header("Lesser General Public License", "3")), ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
              ("BSD-3-Clause", "Copyright (c) 2020, Foo\nAll rights reserved.\n\n" + "\n\n".join(clauses)),
              ("BSD-2-Clause", "Copyright (c) 2020, Foo\nAll rights reserved.\n\n" + "\n\n".join([clauses[0], clauses[2]])),
              ("MIT", "a\nThis project is released under the MIT License.\nb"), ("", "This project is released under the Foo License."),
              ("GPL-3.0", "Preamble\n\nThe GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n\nx y")]
    rows = licenses.stated_licenses(spark.createDataFrame(list(enumerate(t for _, t in stated)), "doc_id long, text string")).collect()
    assert [r.licenses for r in sorted(rows)] == [name for name, _ in stated]


def test_decontam(docs, empty, bench):
    rows = _by_id(decontam.match_benchmark(docs, bench, into="hit"))
    found = {r.doc_id: r.hit for r in rows}
    assert found[1]["items"] == ["1", "2"] and (found[1].starts, found[1].ends) == ([1], [21])
    assert found[6]["items"] == ["3"] and found[3].n_words == 0 and found[9].starts == []
    # One item a block: the passes add up to the same.
    again = _by_id(decontam.match_benchmark(docs, bench, block_bytes=1, into="hit"))
    assert [r.hit for r in again] == [r.hit for r in rows]
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 6
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == len(ROWS)
    assert decontam.match_benchmark(empty, bench, into="hit").count() == 0


def test_results_replace_columns_of_their_name(docs, bench):
    """``found``, ``language``, ``spans`` and ``repeated`` are columns of the table already."""
    model = language.references(docs.select("text", "lang"))
    for frame, into in ((decontam.match_benchmark(docs, bench), "found"), (language.identify(docs, model), "language"),
                        (rlz.duplicate_spans(docs), "spans"), (suffix_bwt.repeated_bytes(docs), "repeated")):
        assert frame.columns.count(into) == 1 and frame.columns[-1] == into and frame.count() == len(ROWS)
        assert "struct" in dict(frame.dtypes)[into]


def _plain_matches(words, texts, window):
    """Longest common runs of a document and each text from their left ends, window or whole text at least."""
    out = set()
    for item, text in texts:
        best = {}
        for start in range(len(words)):
            for place in range(len(text)):
                if start and place and words[start - 1] == text[place - 1] and len(text) >= window:
                    continue
                n = 0
                while start + n < len(words) and place + n < len(text) and words[start + n] == text[place + n]:
                    n += 1
                if n >= window or n == len(text) > 0 and not place:
                    best[start] = max(best.get(start, (0, 0)), (n, -place))
        out |= {(item, start, n, -place) for start, (n, place) in best.items()}
    return out


def test_longest_matches(spark):
    draw = random.Random(11)
    items = [(f"i{k}", " ".join(draw.choice("abc") for _ in range(draw.randint(1, 40)))) for k in range(12)]
    rows = [(k, " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 60)))) for k in range(60)]
    rows.append((99, "x " + items[3][1] + " y " + items[3][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench_ = spark.createDataFrame(items, "item_id string, text string")
    texts = [(i, t.split()) for i, t in items]
    for block_bytes in (1 << 20, 1):
        for r in decontam.match_benchmark(docs, bench_, window=5, block_bytes=block_bytes).collect():
            got = {(m["item"], m["start"], m["length"], m["item_start"]) for m in r.found.matches}
            assert got == _plain_matches(r.text.split(), texts, 5), r


def test_near_duplicates(docs, empty):
    rows = _by_id(setsketch.near_duplicates(docs))
    of = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == len(ROWS) and of[None] is None and rows[-1].kept and of[7] == 6 and of[10] == 9 and of[12] == 11 and of[3] == 3 and of[4] == 4
    kept = setsketch.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9, 11] + [2] * (of[2] == 2) or of[2] == 1
    assert setsketch.near_duplicates(empty).count() == 0


def test_warc(spark, tmp_path):
    body = "<p>" + "ü" * 100
    rows = [(3, "http://a/ b", body), (1, None, body), (2, "http://a/\r\nX: y", body), (1, None, body), (4, "u", None), (5, "u", ""),
            (6, "u", "short"), (7, "u", "short"), (None, "u", body)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    warc.write_packages(pages, str(tmp_path / "w"))
    found = sorted(((r.page_id or 0, r.record_type, r.payload_bytes, r.refers_to) for r in warc.read_packages(spark, str(tmp_path / "w")).collect()),
                   key=str)
    assert found == sorted([(3, "revisit", 203, 1), (1, "response", 203, None), (2, "revisit", 203, 1), (1, "response", 203, None),
                            (4, "response", 0, None), (5, "response", 0, None), (6, "response", 5, None), (7, "response", 5, None),
                            (0, "revisit", 203, 1)], key=str)
    warc.write_packages(pages.limit(0), str(tmp_path / "e"))
    assert warc.read_packages(spark, str(tmp_path / "e")).count() == 0


def test_pipeline_stages(docs, empty, spark, bench, tmp_path):
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, empty):
            out = stage(spark, given, str(tmp_path))
            out.count()
            assert name == "mix" or out.columns == given.columns
