"""The methods themselves, against plain Python on small inputs."""

import io
import random
import re
import zipfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbside.llm import language, mixing, setsketch, suffix_bwt, toxicity, warc
from kerbside.llm.graph import components
from kerbside.llm.text import WordHashes, held_out

SF = "/root/testdata/sf0.01"


def test_collection_bwt():
    draw = random.Random(3)
    for _ in range(150):
        strings = [bytes(draw.choice(b"ab") for _ in range(draw.randint(0, 14))) for _ in range(draw.randint(1, 6))]
        bwt, lcp = suffix_bwt.collection_bwt(strings)
        suffixes = sorted((s[k:], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
        places = {(i, len(strings[i]) - k): p for k, row in suffix_bwt.suffix_places(bwt, strings) for i, p in enumerate(row) if p >= 0}
        got = [strings[i][k:] for (i, k), _ in sorted(places.items(), key=lambda x: x[1])]
        assert got == [s for s, _, _ in suffixes]
        for a, b, shared in zip(got, got[1:], lcp[1:]):
            # Ends of strings match nothing, so a whole suffix shares its length at most.
            assert shared == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_passage_in_many_surroundings(spark, monkeypatch):
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = letters(600)
    texts = [letters(rng.randrange(150, 400)) + passage + letters(rng.randrange(150, 400)) for _ in range(150)] * 2
    texts += [letters(300) for _ in range(20)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts[:150] + texts[200:])], "doc_id long, text string").repartition(12)
    most, sizes = 5_000, []
    monkeypatch.setattr(suffix_bwt, "BUCKET_MOST", most, raising=False)
    answered = suffix_bwt.answered

    def watched(messages, work):
        sizes.append(max([sum(map(len, r.data)) for r in messages.groupBy("bucket").agg(F.collect_list("data").alias("data")).collect()],
                         default=0))
        return answered(messages, work)

    monkeypatch.setattr(suffix_bwt, "answered", watched)
    rows = suffix_bwt.repeated_bytes(docs, into="cut").collect()
    assert len(sizes) > 1 and max(sizes[1:]) < 2 * most, sizes
    seen = Counter(t[k : k + 200] for t in (r.text for r in rows) for k in range(len(t) - 199))
    for r in rows:
        gone = [False] * len(r.text)
        for k in range(len(gone) - 199):
            if seen[r.text[k : k + 200]] > 1:
                gone[k : k + 200] = [True] * 200
        assert r.cut.kept.decode() == "".join(c for c, g in zip(r.text, gone) if not g)


def test_suffix_automaton():
    text = "abracadabra banana"
    parser = language.CrossParser([("x", text)])
    counts, sizes = parser.phrases(["abracad", "banbra", "zzz", "q", ""])
    assert counts[:, 0].tolist()[0] == 1 and sizes.tolist() == [7, 6, 3, 1, 0]

    def phrases(s):
        n = at = 0
        while at < len(s):
            k = at + 1
            while k < len(s) and s[at : k + 1] in text:
                k += 1
            n, at = n + 1, k
        return n

    draw = random.Random(5)
    texts = ["".join(draw.choice("abrcdn ") for _ in range(draw.randint(1, 60))) for _ in range(200)]
    texts = [" ".join(t.split()) or "a" for t in texts]
    assert parser.phrases(texts)[0][:, 0].tolist() == [phrases(t) for t in texts]


def _plain_phrases(text, reference):
    """Greedy longest matches, one after another, by looking for each in the reference."""
    n = at = 0
    while at < len(text):
        k = at + 1
        while k < len(text) and text[at : k + 1] in reference:
            k += 1
        n, at = n + 1, k
    return n


@pytest.mark.parametrize("piece", [1, 2, 7, 16, 512])
def test_phrases_do_not_end_where_pieces_do(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE", piece)
    draw = random.Random(6)
    first, second = ("".join(draw.choice("abc ") for _ in range(n)) for n in (90, 150))
    first, second = (" ".join(t.split()) for t in (first, second))
    parser = language.CrossParser([("x", first), ("y", second)])
    texts = [" ".join("".join(draw.choice("abcd  ") for _ in range(draw.randint(0, 400))).split()) for _ in range(60)]
    got = parser.phrases(texts)[0].tolist()
    assert got == [[_plain_phrases(t, r) if t else got[k][j] for j, r in enumerate((first, second))] for k, t in enumerate(texts)]
    # The reference itself is one phrase, however long.
    assert parser.phrases([second])[0][0, 1] == 1


def test_language_against_plain_parsing(spark):
    """Whole predictions and scores: references as sampled, each text parsed by looking for its phrases."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    model = language.references(language.training_rows(docs), chars=1500)

    def symbols(text):
        return re.sub(r"[^\W\d_]|(.)", lambda m: "|" if m[1] else m[0], re.sub(r"\n", " ", text.lower()), flags=re.S)

    def squeezed(text):
        return re.sub(r"\|+", "|", symbols(text))

    wanted = {}
    known = {c for _, r in model for c in r if c.isalpha()}
    for row in docs.collect():
        text = re.sub(r"[^\W\d_]", lambda m: m[0] if m[0] in known else "\0", squeezed((row.text or "")[:3000]))
        counts = [_plain_phrases(text, squeezed(r)) for _, r in model]
        best = min(range(len(model)), key=lambda k: (counts[k], k))
        first, second = sorted(counts)[:2]
        wanted[row.doc_id] = (model[best][0], round(2 * second / (first + second) - 1, 9))
    found = language.identify(docs.withColumn("text", F.substring("text", 1, 3000)), model).collect()
    assert {r.doc_id: (r.language.pred, round(r.language.score, 9)) for r in found} == wanted


def test_texts_stay_where_no_language_is_learned(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, "123 !", None), (3, None, None), (4, "x", None)], "doc_id long, text string, lang string")
    model = language.references(language.training_rows(docs))
    assert model == [] and [r.doc_id for r in language.drop_undetermined(docs, model).orderBy("doc_id").collect()] == [1, 4]


def test_copies_do_not_fill_the_reference(spark):
    rows = [(k, "same words again " * 40, "en") for k in range(300)] + [(300 + k, f"!! 12 text{chr(97 + k)} " + "word " * k, "en") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (_, text), = language.references(docs.select("text", "lang"), chars=5000, per_document=100)
    assert text.count("same words") < 10 and all(f"text{chr(97 + k)}" in text for k in range(20)) and not text.startswith("!")


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.references(language.training_rows(docs))
    assert all(len(text) <= language.REFERENCE_CHARS for _, text in model)
    held = language.identify(docs.where(held_out("doc_id", 5, 0)).where("n_chars > 30"), model)
    rows = held.select("lang", "language.pred").collect()
    assert sum(r.lang == r.pred for r in rows) > 0.97 * len(rows)


def test_levenshtein_automaton():
    trie = toxicity.Trie({w: 1.0 for w in ("stupid", "idiot", "scum")})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    draw = random.Random(1)
    words = ["stupd", "stupidd", "stopid", "tupid", "astupid", "idot", "cum", "stupido", "stpuid", "i", ""]
    words += ["".join(draw.choice("stupidcmo") for _ in range(draw.randint(1, 8))) for _ in range(2000)]
    for word in words:
        near = any(distance(word, t) <= 1 for t in ("stupid", "idiot", "scum"))
        assert bool(trie.near(word)) == near, word


def test_toxicity_context_and_accuracy(spark):
    lexicon = toxicity.Lexicon({"moron": 0.95, "lowe*": 0.9})
    plain, quoted, told = lexicon.score("such a moron here"), lexicon.score('he used "moron" here'), lexicon.score("you moron")
    assert quoted < 0.4 < plain <= told
    assert 0 < lexicon.score("such a morom here") < plain and lexicon.score("loweisch ding") > 0.5
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    both = docs.join(labels, "doc_id")
    model = toxicity.learn(both.where(~held_out("doc_id", 3, 1)).select("text", "toxic"))
    rows = both.where(held_out("doc_id", 3, 1)).select("text", "toxic").collect()
    hits = [(model.score(r.text) >= 0.7, r.toxic) for r in rows]
    assert sum(h == bool(t) for h, t in hits) > 0.96 * len(hits)
    assert sum(h for h, t in hits if not t) < 0.01 * len(hits)


def test_targets_and_dual(spark):
    draw = random.Random(2)
    rows = [(k, " ".join("w" * draw.randint(1, 200)), draw.choice([None, "", "a", "b", "Ä", "z"])) for k in range(400)]
    rows += [(1000 + k, "w " * 900, "a") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s], left = 2.0 * sizes[s], left - 2 * sizes[s]
        free -= over
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    found = mixing.mixed(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    for source, part in found.groupby(found.source.fillna("null")):
        source = None if source == "null" else source
        assert part.target.iloc[0] == pytest.approx(target[source], rel=1e-9)
        assert (part.rate * part["size"]).sum() == pytest.approx(target[source], rel=1e-4)
        assert part.taken.sum() == pytest.approx(target[source], rel=0.02)
        rates = part[(part.rate > 1e-6) & (part.rate < 2 - 1e-6)]
        if len(rates):  # tilted: the log odds of the rates are in proportion to size
            tilt = np.log(rates.rate / (2 - rates.rate)) / rates["size"]
            assert np.allclose(tilt, tilt.mean(), rtol=0.02, atol=1e-6)


def test_zip_against_zipfile(tmp_path):
    records = [(k, warc.record(k, f"http://x/{k}", b"<p>%d" % k * k, "0" * 64, None)) for k in range(50)]
    data = b"".join(piece + b"\n" for piece in warc._Package().pieces(iter(records)))
    with zipfile.ZipFile(io.BytesIO(data)) as opened:
        assert opened.testzip() is None
        assert opened.read("archive/data.warc") == b"".join(r for _, r in records)
        assert len(opened.read("indexes/index.cdxj").splitlines()) == 50
    plain = tmp_path / "plain.zip"
    with zipfile.ZipFile(plain, "w") as made:  # another writer's archive, without ZIP64 fields
        made.writestr("archive/data.warc", b"abc")
        made.comment = b"a comment PK\x05\x06 with a mark"
    source = pa.PythonFile(open(plain, "rb"))
    method, start, size = warc.directory(source, plain.stat().st_size)[b"archive/data.warc"]
    assert method == 0 and source.read_at(size, start) == b"abc"
    assert zlib.crc32(b"") == 0


def test_sketches_estimate_and_merge():
    draw = random.Random(4)
    words = [f"w{k}" for k in range(5000)]
    hashes = WordHashes()
    for share in (0.3, 0.75, 0.95):
        a = draw.sample(words, 1000)
        b = a[: int(1000 * share)] + draw.sample([w for w in words if w not in a], 400)
        x, y = (np.unique(hashes.array([w.encode() for w in s])) for s in (a, b))
        s, t, u = setsketch.registers([x, y, np.union1d(x, y)], 2000)
        assert (setsketch.merge(s, t) == u).all()
        more, less = np.array([(s > t).sum()]), np.array([(s < t).sum()])
        got = setsketch.likely_jaccard(more, less, 2000 - more - less, np.array([len(x)]), np.array([len(y)]))[0]
        want = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs(got - want) < 0.05
        # The closed form is the maximum of the likelihood.
        v = len(x) / (len(x) + len(y))
        grid = np.linspace(0.001, min(v / (1 - v), (1 - v) / v) - 1e-6, 4000)
        likelihood = more * np.log(v - (1 - v) * grid) + less * np.log((1 - v) - v * grid) + (2000 - more - less) * np.log(grid * 1.0)
        assert abs(grid[likelihood.argmax()] - got) < 0.01


def test_wide_groups(spark, monkeypatch):
    """Blocks of a few members, so that leaders and outsiders come into play, give what all pairs give."""
    draw = random.Random(6)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(120):
        words = list(base)
        for _ in range(draw.choice([1, 2, 3, 4])):
            words[draw.randrange(60)] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"y{draw.randrange(500)}" for _ in range(40)) for _ in range(30)]
    monkeypatch.setattr(setsketch, "WIDE_SKETCHES", 25)
    monkeypatch.setattr(setsketch, "WIDE_SETS", 10)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs).collect()}
    sets = [set(zip(*[t.split()[k:] for k in range(5)])) for t in texts]
    least = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                    least[i] = least[j] = min(least[i], least[j])
        if all(least[i] == least[least[i]] for i in range(len(texts))):
            break
    assert found == dict(enumerate(least))


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (None, 3), (205, 200), (200, 203)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 203: 200, 205: 200}


def _plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Source targets by handing the excess on until none is above its cap."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[k % len(weights)] for k, n in enumerate(names)}
    target, open_ = {}, set(names)
    left = share * sum(sizes.values())
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if weight[n] * level > most * sizes[n]}
        if not over:
            return target | {n: weight[n] * level for n in open_}
        for n in over:
            target[n] = most * sizes[n]
            left -= target[n]
        open_ -= over
    return target


@pytest.mark.parametrize("bucket_rows", [7, 500, 10**9])
def test_mix_against_plain_rounding(spark, monkeypatch, bucket_rows):
    """Targets, rates by bisection and every class's copies, on either side of a bucket's size and over many sources."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    draw = random.Random(4)
    rows = [(k, " ".join(["w"] * draw.choice([0, 1, 2, 5, 5, 40])), draw.choice([f"s{n}" for n in range(30)] + ["hot"] * 30 + [None])) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mixed(docs).collect()}
    size = {k: len((t or "").split()) for k, t, _ in rows}
    total, classes = Counter(), Counter()
    for k, _, source in rows:
        total[source] += size[k]
        classes[source, size[k]] += 1
    target = _plain_targets(total)
    for source in total:
        assert got[next(k for k, _, s in rows if s == source)].target == pytest.approx(target[source])
        scale = sum(z * z * n for (s, z), n in classes.items() if s == source) / max(1, total[source])
        low, high = -50.0, 50.0
        for _ in range(200):  # the tilt that meets the target, by bisection
            middle = (low + high) / 2
            words = sum(2 * z * n / (1 + np.exp(-middle * z / max(scale, 1e-9))) for (s, z), n in classes.items() if s == source)
            low, high = (middle, high) if words < target[source] else (low, middle)
        own = sorted((z, n) for (s, z), n in classes.items() if s == source)
        for z, n in own:
            docs_of = [got[k] for k, _, s in rows if s == source and size[k] == z]
            rate = docs_of[0].rate
            if 0 < target[source] < 2 * total[source] - 1e-9:
                assert rate == pytest.approx(2 / (1 + np.exp(-low * z / scale)), abs=1e-4)
            copies = [r.copies for r in docs_of]
            assert all(int(rate) <= c <= int(rate) + 1 for c in copies) and abs(sum(copies) - rate * n) < 1 + 1e-6
        assert abs(sum(got[k].taken for k, _, s in rows if s == source) - target[source]) <= 40


def test_mix_does_not_depend_on_buckets_much(spark, monkeypatch):
    """A hot class in one bucket or in many takes the same number of copies."""
    docs = spark.createDataFrame([(k, "a b c", "x" if k < 1200 else "y") for k in range(2000)], "doc_id long, text string, source string")
    seen = set()
    for bucket_rows in (50, 10**9):
        monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
        seen.add(tuple(sorted((r.source_size, r["sum(copies)"]) for r in mixing.mixed(docs).groupBy("source_size").sum("copies").collect())))
    assert len(seen) == 1


def _one_edit(a, b):
    """Whether the edit distance of two words is one, by the table of all prefixes."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1] == 1


def _plain_toxicity(labelled, texts):
    """Lexicon and scores, with every count taken document by document and every pair of words compared."""
    words_of = lambda t: {w for w in re.findall(r"\w+", t.lower()) if len(w) > 2}
    starts = lambda w: [w[:n] + "*" for n in (4, 5, 6, 7, 8) if len(w) >= n]
    toxic, clean = Counter(), Counter()
    for text, label in labelled:
        own = words_of(text or "")
        (toxic if label else clean).update(own | {s for w in own for s in starts(w)})
    share = sum(label for _, label in labelled) / len(labelled)
    frequent = [t for t, n in toxic.items() if n >= 3]
    weight = {t: (toxic[t] + share) / (toxic[t] + clean[t] + 1) for t in {*toxic, *clean}}

    def ratio(t):
        n, a, b = toxic[t] + clean[t], toxic[t], clean[t]
        return a * np.log(a / n / share) + (b * np.log(b / n / (1 - share)) if b else 0)

    chosen = [t for t in frequent if ratio(t) >= np.log(len(frequent)) + 1 and weight[t] >= 0.8]
    terms = {t: weight[t] for t in chosen if not t.endswith("*") or toxic[t] >= 1.5 * max(
        [toxic[w] for w in chosen if not w.endswith("*") and t in starts(w)], default=0)}
    stems = {t: w for t, w in terms.items() if t.endswith("*")}
    terms = {t: w for t, w in terms.items() if not (t.endswith("*") and any(
        len(s) < len(t) and t.startswith(s[:-1]) and stems[s] >= w for s in stems))}
    fuzzy = [t for t in terms if not t.endswith("*") and len(t) >= 5]
    near = {w for w in clean if not w.endswith("*") and len(w) >= 4 and w not in terms and any(_one_edit(w, t) for t in fuzzy)}
    held = {w: 0.0 if weight[w] < 0.5 else weight[w] for w in near}
    neighbours = {t: sum(not held[w] and _one_edit(w, t) for w in near) for t in fuzzy}

    def of(word):
        found = max([terms.get(word, 0), *(terms.get(s, 0) for s in starts(word))])
        if not found and len(word) >= 4 and held.get(word, 1):
            spellings = [len(t) * 25 + len(t) + (len(t) + 1) * 26 for t in fuzzy]
            close = [terms[t] * (1 - (neighbours[t] + 1) / (n + 2)) for t, n in zip(fuzzy, spellings) if _one_edit(word, t)]
            found = min(held.get(word, 1), max(close, default=0))
        return found

    scores = []
    for text in texts:
        spots, left = list(re.finditer(r"\w+", (text or "").lower())), 1.0
        for k, spot in enumerate(spots):
            if len(spot.group()) > 2 and (hit := of(spot.group())):
                around = {s.group() for s in spots[max(0, k - 5) : k] + spots[k + 1 : k + 6]}
                left *= 1 - hit * (1.0 if around & {"you", "your"} else 0.5 if around & {"said", "word"} else 0.75)
        scores.append(1 - left)
    return terms, scores


def test_toxicity_against_plain_counting(spark):
    draw = random.Random(12)
    bad, near = ["stupidos", "stupidly", "idiotic", "moronic"], ["stupidor", "idiotics", "moronik", "idiotik"]
    plain = ["garden", "window", "moronica", "paper", "you", "said", "river", "stone", "idiotica", "cloud"]

    def text(words, n):
        return " ".join(draw.choice(words) for _ in range(n))

    labelled = [(text(plain, 8) + " " + text(bad, 1) + " " + text(plain, 4), 1) for _ in range(60)] + [(text(plain, 14), 0) for _ in range(200)]
    labelled += [(None, 0), ("", 1), ("stupidor garden", 0), ("moronik", 1)]
    texts = [text(plain + bad + near, draw.randint(0, 9)) for _ in range(200)] + [None, ""]
    terms, want = _plain_toxicity(labelled, texts)
    lexicon = toxicity.learn(spark.createDataFrame(labelled, "text string, toxic int"))
    assert {**lexicon.words, **{t + "*": w for t, w in lexicon.beginnings.items()}} == pytest.approx(terms)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.scored(docs, lexicon).collect()}
    assert [got[k] for k in range(len(texts))] == pytest.approx(want) and max(want) > 0.7 and min(want) == 0


def test_links_are_stars():
    """A chain of links in a group, two of its rows known to be connected, comes out as a star around the least component."""
    import pyarrow as pa
    rows = pa.RecordBatch.from_pydict({
        "key": [1] * 5, "block": [0] * 5, "node": [9, 5, 7, 3, 8], "component": [9, 5, 7, 3, 3], "side": [0] * 5, "size": [0] * 5, "payload": [b""] * 5})
    chain = lambda found, starts, ends, side: [(0, 5, np.array([0, 1, 2]), np.array([1, 2, 3]))]
    edges = [e for batch in setsketch._linked_rows(chain, [rows]) for e in zip(*batch.to_pydict().values())]
    assert sorted(edges) == [(5, 3), (7, 3), (9, 3)]
