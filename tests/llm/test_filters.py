"""op1, op2, op3, op5, op10: text filters against plain versions, and odd inputs."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from swident.llm import language, licenses, quality_classifier, quality_rules, toxicity, words
from swident.llm.common import fold, held_out

DOCS = "doc_id long, text string"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "a", "é!É\n\n日本 x", "\x00\x1f\x85\xa0 K", "a " * 5000, "A" * 50_000, "😀 x😀"]


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    lexicon = ["".join(rng.choices("aeioutrsn", k=rng.randint(2, 6))) for _ in range(300)]
    return lambda n: " ".join(rng.choices(lexicon, k=n))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


@pytest.mark.parametrize(("table", "pattern", "fold_case"), [(words.SPACED, SPACED, False), (words.ALNUM, ALNUM, True)])
def test_scan_equals_patterns(table, pattern, fold_case):
    seen = {}
    for limit in (16, 1 << 20):
        at = 0
        for s in words.slices(pa.array(ODD, pa.string()), table, limit):
            h = s.hashes(fold_case)
            assert s.first == at
            for i in range(s.n_docs):
                text = (ODD[s.first + i] or "").translate(LOW) if fold_case else ODD[s.first + i] or ""
                mine = h[s.bounds[i] : s.bounds[i + 1]].tolist()
                found = pattern.findall(text)
                assert len(mine) == len(found)
                for w, x in zip(found, mine, strict=True):
                    assert seen.setdefault(w, x) == x
            at += s.n_docs
        assert at == len(ODD)
    assert len(set(seen.values())) == len(seen)
    assert list(words.slices(pa.array([], pa.string()), table)) == []


def plain_rules(text):
    w = SPACED.findall(text or "")
    three = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = collections.Counter(three)
    cover = {j for i, g in enumerate(three) if count[g] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if SPACED.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover)


def test_quality_rules(spark, prose):
    good = [prose(80) for _ in range(400)]
    bad = [" ".join(x + "&&&" for x in prose(80).split()) for _ in range(100)]
    texts = [*good, *bad, *ODD, "x y z " * 40, "l1 #\nl1 #\n\nl2|"]
    docs = frame(spark, texts).withColumn("n_words", F.lit("clash"))
    out = {r.doc_id: r for r in quality_rules.quality_rules(docs, spark.createDataFrame([(i,) for i in (*range(0, 400, 2), 999, None)], "doc_id long")).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        r = out[i]
        e = plain_rules(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == e, t
        assert r.base_failed == (e[0] < 50 or 100 * e[4] > 50 * e[0]) and not (r.base_failed and r.kept)
    assert all(out[i].kept for i in range(400)) and not any(out[i].kept for i in range(400, 500))
    # the ratio itself, from plain counts of hashed uni- and bigrams without the document's own
    trusted = set(range(0, 400, 2))
    n = quality_rules.BUCKETS
    grams = {}
    for s in words.slices(pa.array(texts), words.SPACED):
        bucket, doc = quality_rules._features(s, n)
        for d in range(s.n_docs):
            grams[s.first + d] = bucket[doc == d]
    for i in (0, 1, 405):
        raw = np.bincount(np.concatenate([g for j, g in grams.items() if j != i]), minlength=n)
        target = np.bincount(np.concatenate([grams[j] for j in trusted if j != i]), minlength=n)
        ratio = np.log((target + 4) / (raw * target.sum() / raw.sum() + 4))
        assert abs(out[i].llr - ratio[grams[i]].mean()) < 1e-9
    assert quality_rules.quality_rules(docs.limit(0), spark.createDataFrame([], "doc_id long")).count() == 0


def test_license_scan(spark, prose):
    mit = next(t for label, t, _ in licenses.TEMPLATES if label == "mit" and len(t) > 60)
    near = mit.replace("hereby", "herebx")
    texts = [
        prose(30) + "\nReleased under the MIT License.", prose(20) + " Licensed under the Apache License, Version 2.0. " + prose(5), "GNU General Public License", "mit x license", mit.upper(), near,
        "Licensed under CC BY-NC 4.0", prose(50), *ODD, "mit license " * 3000, "MIT LICENSE\nApache-License", prose(5000) + " " + mit,
    ]
    docs = frame(spark, texts).withColumn("labels", F.lit(1))
    docs = docs.unionByName(docs.limit(1))
    out = collections.defaultdict(list)
    for r in licenses.license_scan(docs).collect():
        out[r.doc_id].append(r)
    assert {i: len(v) for i, v in out.items()} == {i: 1 + (i == 0) for i in range(len(texts))}
    for i, t in enumerate(texts):
        w = ALNUM.findall((t or "").translate(LOW))
        at = sorted((k, label) for phrase, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split())
        r = out[i][0]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None), t
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    got = {i: (v[0].labels, v[0].score) for i, v in out.items()}
    assert got[0] == ("mit", 1.0) and got[1] == ("apache", 1.0) and got[4] == ("mit", 1.0) and got[6] == ("cc-by-nc", 1.0) and got[7] == ("", 0.0)
    # the mandatory phrase is broken, so the near miss has no label
    assert got[5] == ("", 0.0) and got[len(texts) - 1] == ("mit", 1.0)
    assert licenses.license_scan(docs.limit(0)).count() == 0


def plain_labels(text):
    """Label -> best score at any shift; and the best of words in their exact places."""
    w, found, exact = ALNUM.findall((text or "").translate(LOW)), {}, 0.0
    for _, label, body, keys, _ in licenses.bodies():
        for shift in range(-len(body), len(w)):
            near = sum(any(0 <= shift + k + d < len(w) and w[shift + k + d] == x for d in range(-licenses.SLIP, licenses.SLIP + 1)) for k, x in enumerate(body))
            span = " " + " ".join(w[max(shift - licenses.SLIP, 0) : max(shift + len(body) + licenses.SLIP, 0)]) + " "
            if near / len(body) >= licenses.MIN_SCORE and all(k in span for k in keys):
                found[label] = max(found.get(label, 0), near / len(body))
                same = sum(0 <= shift + k < len(w) and w[shift + k] == x for k, x in enumerate(body)) / len(body)
                exact = max(exact, same if same >= licenses.MIN_SCORE else 0.0)
    return found, exact


def test_license_labels_against_all_shifts(spark, prose):
    rng = random.Random(5)
    texts = []
    for _, text, _ in licenses.TEMPLATES:
        w = text.split()
        changed = [x if rng.random() > 0.06 else "zzz" for x in w]
        longer = [*w[: len(w) // 2], "inserted", *w[len(w) // 2 :]]
        texts += [prose(9) + " " + text, " ".join(changed), " ".join(longer) + " " + prose(4), " ".join(w[: len(w) * 2 // 3]), " ".join(w[1:])]
    texts += ["released under the mit \u212aicense", "MIT LICENSE \u0130 mit license", "released under the mit license " * 40]
    docs = frame(spark, texts).unionByName(frame(spark, texts).where("doc_id % 3 = 0"))
    out = collections.defaultdict(list)
    for r in licenses.license_scan(docs.withColumn("template", F.lit("clash"))).collect():
        out[r.doc_id].append((r.labels, r.base_labels, r.score))
    for i, t in enumerate(texts):
        want, exact = plain_labels(t)
        assert len(set(out[i])) == 1 and len(out[i]) == 1 + (i % 3 == 0)
        labels, base, score = out[i][0]
        assert set(filter(None, labels.split(","))) == set(want) | set(filter(None, base.split(","))), t
        assert exact <= score <= max(want.values(), default=0.0), t


def test_no_python_in_native_plans(spark, prose):
    plan = licenses.license_scan(frame(spark, [prose(9)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def plain_sizes(text, content):
    """Bytes of the text's chunks under each language's dictionary, by plain zstandard."""
    import zstandard

    data, out = re.sub(r"[\W\d_]+", " ", text.lower()).encode(), {}
    for lang, raw in content.items():
        size = 0
        for a in range(0, len(data), language.CHUNK_BYTES):
            d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            size += len(c.compress(data[a : a + language.CHUNK_BYTES]))
        out[lang] = size
    return out


def test_language_against_plain_compression(spark):
    rng = random.Random(1)
    tongue = {"xx": "the and of to in is that with".split(), "yy": "der und die nicht mit von das ist".split(), "zz": "élan où été çà même près déjà là".split()}
    rows = [(i, " ".join(rng.choices(tongue[lang], k=rng.choice([2, 9, 60, 400]))), lang) for i, lang in enumerate(sorted(tongue) * 60)]
    more = [None, "", "12 !", "the and of that is with in to the of", "the der élan", "q", "und the", " ".join(rng.choices(tongue["yy"], k=20_000))]
    odd = [(1000 + i, t, None) for i, t in enumerate(more)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumns({"_lang": F.lit(0), "place": F.lit("x"), "h": F.lit(1), "score": F.lit("s")})
    docs = docs.unionByName(docs.where("doc_id in (1, 2, 1004)"))  # repeated rows
    content = language.sample_dictionaries(docs, fold(F.col("doc_id"), 5) != 0)
    # the sample again, plainly: the documents with the smallest hashes, an equal share of each
    order = [r.doc_id for r in docs.where((fold(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull()).select("doc_id", F.xxhash64("doc_id").alias("k")).distinct().orderBy("k").collect()]
    by = {i: (t, lang) for i, t, lang in rows}
    assert content == {lang: language.dictionary_of([language.letters_only(by[i][0]) for i in order if by[i][1] == lang][: language.DOCS]) for lang in tongue}
    out = collections.defaultdict(set)
    found = language.identify(docs, content, ["doc_id", "score"])
    for r in found.collect():
        out[r.doc_id].add((r._swident_lang, r._swident_score, r._swident_margin, r._swident_rejected))
    assert found.count() == len(rows) + len(odd) + 3
    for i, text, _ in rows + odd:
        ((lang, score, margin, rejected),) = out[i]
        if not text or not re.search(r"[^\W\d_]", text):
            assert (lang, score, margin, rejected) == ("und", 0.0, 0.0, True)
            continue
        size = plain_sizes(text, content)
        first, second = sorted(size.values())[:2]
        assert lang == min(x for x in size if size[x] == first)
        assert margin == pytest.approx((second - first) / first) and rejected == (margin < 0.005)
        assert score == pytest.approx(1 / sum(2.0 ** -min(v - first, 200) for v in size.values()))
    assert {r._swident_lang for r in language.identify(docs, {}, ["doc_id"]).collect()} == {"und"}
    assert language.identify(docs.limit(0), content, ["doc_id"]).count() == 0
    assert language.sample_dictionaries(docs.limit(0), F.lit(True)) == {}


def labelled(spark, prose, mark):
    rng = random.Random(2)
    texts, y = [], []
    for i in range(400):
        bad = i % 4 == 0
        texts.append(mark(prose(60), bad, rng))
        y.append(int(bad))
    docs = frame(spark, texts).withColumn("y", F.lit("clash"))
    return docs, spark.createDataFrame(list(enumerate(y)), "doc_id long, y int"), texts, y


INSULTS = ["grob", "fies", "doof", "mies", "blod"]


def insult(text, bad, rng):
    w = text.split()
    for _ in range(3 if bad else 0):
        w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
    return " ".join(w)


def plain_votes(examples, evidence, texts, k=toxicity.K):
    """Neighbours and vote of each text: TF-IDF vectors, all cosines, in plain Python.

    examples are (id, text, label); a text that is given as its number in them meets the others only.
    """
    bags = [collections.Counter(ALNUM.findall((t or "").translate(LOW))) for _, t, _ in examples]
    full = [i for i, b in enumerate(bags) if b]
    df = collections.Counter(w for i in full for w in bags[i])
    idf = lambda w: np.log((2 + len(full)) / (1 + df[w])) * (1 + evidence.get(w, 0)) if w in df else np.log(2 + len(full))

    def unit(bag):
        v = {w: (1 + np.log(n)) * idf(w) for w, n in bag.items()}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    known, prior = {i: unit(bags[i]) for i in full}, np.mean([y for *_, y in examples])
    out = []
    for t in texts:
        q = known[t] if isinstance(t, int) else unit(collections.Counter(ALNUM.findall((t or "").translate(LOW))))
        near = sorted((-round(sum(x * known[i].get(w, 0) for w, x in q.items()), 6), i) for i in full if not (isinstance(t, int) and i == t))[:k]
        near = [(-c, i) for c, i in near if c < 0]
        w = [c * c for c, _ in near]
        out.append((near, (sum(x * examples[i][2] for x, (_, i) in zip(w, near, strict=True)) + prior) / (sum(w) + 1)))
    return out


def test_toxicity_against_plain_cosines(spark, prose):
    docs, labels, texts, y = labelled(spark, prose, insult)
    docs = docs.drop("y")
    fitted = toxicity.fit(docs, labels, "y", fold(F.col("doc_id"), 4) != 2)
    index = fitted.index
    examples = [(i, texts[i], y[i]) for i in range(400) if spark_fold(i, 4) != 2]
    evidence = toxicity.telling(spark.createDataFrame([(t, v) for _, t, v in examples], "text string, y int"))
    assert set(evidence) == set(INSULTS)
    # the scale: votes on examples by the others
    loo = np.array([v for _, v in plain_votes(examples, evidence, range(len(examples)))])
    assert np.allclose(index.scale, toxicity.fit_scale(loo, np.array([v for *_, v in examples])), rtol=1e-3)
    new = [prose(30), texts[1], texts[0], "grob " + prose(5), "nowhere known", prose(3000), *ODD]
    frame_ = frame(spark, new).withColumns({"score": F.lit("clash"), "_swident_text": F.lit(1)})
    out = {r.doc_id: r for r in toxicity.score(frame_, fitted, ["doc_id", "score"], evidence=True).collect()}
    none = 0
    for i, ((near, vote), t) in enumerate(zip(plain_votes(examples, evidence, new), new, strict=True)):
        got = out[i]._swident_evidence
        assert [e.cosine for e in got] == pytest.approx([c for c, _ in near], abs=2e-6)
        far = {e.example: e.cosine for e in got}
        assert all(str(examples[j][0]) in far or c <= near[-1][0] + 2e-6 for c, j in near)
        assert all(e.label == dict((str(a), v) for a, _, v in examples)[e.example] for e in got)
        a, b = index.scale
        assert out[i]._swident_score == pytest.approx(1 / (1 + np.exp(-a * np.log(vote / (1 - vote)) - b)) if near else index.without, abs=1e-4)
        none += not near
    assert none <= len([t for t in new if not set(ALNUM.findall((t or "").translate(LOW))) & {w for _, x, _ in examples for w in x.split()}])
    held = {r.doc_id: r._swident_score for r in toxicity.score(docs, fitted, ["doc_id"]).collect() if spark_fold(r.doc_id, 4) == 2}
    assert all((p >= 0.3) == bool(y[i]) for i, p in held.items())


def test_blocks_that_are_left_out_hold_no_neighbour(monkeypatch):
    """Search over many blocks equals all cosines, and leaves blocks out."""
    rng = np.random.default_rng(3)
    topics = [rng.choice(3000, 60, replace=False) for _ in range(12)]
    rows = []
    for i in range(1500):
        term = np.unique(np.concatenate((rng.choice(topics[i % 12], rng.integers(9, 60)), rng.integers(0, 3000, 4)))).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        rows.append((i, int(i % 12 == 0), np.sort(term), rng.integers(1, 4, len(term))))
    rows += [(2000 + i, 0, r[2], r[3]) for i, r in enumerate(rows[:40])]  # copies: ties
    monkeypatch.setattr(toxicity, "DENSE", 100)
    index = toxicity.build(rows, {})
    full = np.zeros((index.n, len(index.hashes)))
    for i in range(index.n):
        at = np.arange(index.first[i], index.first[i + 1])
        full[i, index.term[at]] = index.weight[at]
    which = np.arange(0, index.n, 7)
    bounds = np.concatenate(([0], np.cumsum(index.first[which + 1] - index.first[which])))
    term = np.concatenate([index.term[index.first[i] : index.first[i + 1]] for i in which])
    weight = np.concatenate([full[i, index.term[index.first[i] : index.first[i + 1]]] for i in which])
    computed = []
    index.dense = Counted(index.dense, computed)
    got = list(index.nearest(bounds, term, weight, 15))
    for i, (ids, cosine) in zip(which, got, strict=True):
        every = full @ full[i]
        want = np.lexsort((index.by_id, -np.round(every, 12)))[:15]
        assert ids.tolist() == want.tolist() and np.allclose(cosine, every[want])
    batches = -(-len(which) // toxicity.BATCH)
    assert sum(computed) < 0.9 * batches * index.n


class Counted:
    """An array that notes how many columns are read."""

    def __init__(self, array, log):
        self.array, self.log = array, log

    def __len__(self):
        return len(self.array)

    def __getitem__(self, key):
        found = self.array[key]
        self.log.append(found.shape[1])
        return found


def test_toxicity_of_odd_inputs(spark, prose):
    docs, labels, texts, y = labelled(spark, prose, insult)
    docs = docs.drop("y")
    index = toxicity.fit(docs, labels, "y", F.lit(True))
    # repeated rows and labels change nothing
    again = toxicity.fit(docs.unionByName(docs.limit(90)), labels.unionByName(labels.limit(50)), "y", F.lit(True))
    assert again.index.ids == index.index.ids and np.array_equal(again.index.weight, index.index.weight) and again.index.scale == index.index.scale
    odd = toxicity.score(frame(spark, ODD), index, ["doc_id"]).collect()
    assert len(odd) == len(ODD) and all(0 <= r._swident_score <= 1 for r in odd)
    none = toxicity.fit(docs, labels.limit(0), "y", F.lit(True))
    assert {r._swident_score for r in toxicity.score(frame(spark, ODD), none, ["doc_id"], evidence=True).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), index, ["doc_id", "text"]).count() == 0
    few = toxicity.fit(docs, labels.limit(3), "y", F.lit(True))
    assert few.index.n == 3 and all(0 <= r._swident_score <= 1 for r in toxicity.score(docs, few, ["doc_id"]).collect())


def spark_fold(i, m):
    import zlib

    return zlib.crc32(str(i).encode()) % m


def test_folds(spark):
    rows = spark.range(50).select("id", fold(F.col("id"), 7).alias("f")).collect()
    assert all(r.f == spark_fold(r.id, 7) for r in rows)
    assert spark.range(1).select(held_out(F.lit(None).cast("long"), 7, 2).alias("h")).first().h is False


def test_quality_classifier(spark, prose):
    def mark(text, bad, rng):
        return (text.upper() + "!!! " + text.upper()) if bad and rng.random() < 0.5 else text.replace(" ", "### ") if bad else text + "."

    docs, labels, texts, y = labelled(spark, prose, mark)
    ranker = quality_classifier.fit(docs.drop("y"), labels.withColumn("y", 1 - F.col("y")), "y", fold(F.col("doc_id"), 4) != 2)
    out = {r.doc_id: r for r in quality_classifier.classify(docs.drop("y"), ranker, ["doc_id", "text"]).collect()}
    held = [i for i in range(400) if spark_fold(i, 4) == 2]
    assert np.mean([(out[i]._swident_score >= 0.7) == (not y[i]) for i in held]) == 1.0
    odd = quality_classifier.classify(frame(spark, ODD), ranker, ["doc_id"]).collect()
    assert len(odd) == len(ODD) and all(0 <= r._swident_score <= 1 for r in odd)
    none = quality_classifier.fit(docs.drop("y"), labels.where("y = 5"), "y", F.lit(True))
    assert {r._swident_score for r in quality_classifier.classify(frame(spark, ODD), none, ["doc_id"]).collect()} == {0.5}


def test_pairs_follow_the_loss():
    x = np.array([[0.0], [1.0], [2.0], [3.0]] * 10)
    r = quality_classifier.fit_pairs(x, np.array([0, 0, 1, 1] * 10), at=0.7)
    assert r.weights[0] > 0 and (r.score(x) >= 0.7).tolist() == [False, False, True, True] * 10
    cut = (r.latent(np.array([[1.0]])) + r.latent(np.array([[2.0]]))) / 2
    assert abs(r.cut - cut[0]) < 1e-9


def test_all_pairs_and_a_vanishing_gradient(monkeypatch):
    monkeypatch.setattr(quality_classifier, "ROWS", 7)
    rng = np.random.default_rng(4)
    y = (rng.random(90) < 0.4).astype(int)
    x = rng.normal(size=(90, 5)) + y[:, None] * [0.8, 0, -0.5, 0, 0.1]
    r = quality_classifier.fit_pairs(x, y, at=0.6)
    z = ((x - r.mean) / r.scale).clip(-8, 8)

    def plain(w):
        pairs = [(g, b) for g in z[y == 1] for b in z[y == 0]]
        lost = [1 / (1 + np.exp((g - b) @ w)) for g, b in pairs]
        loss = np.mean([np.log1p(np.exp(-((g - b) @ w))) for g, b in pairs]) + quality_classifier.RIDGE / 2 * w @ w
        return loss, -np.mean([p * (g - b) for p, (g, b) in zip(lost, pairs, strict=True)], axis=0) + quality_classifier.RIDGE * w

    loss, grad = plain(r.weights)
    mine = quality_classifier.pair_loss(z[y == 1], z[y == 0], r.weights)
    assert np.abs(grad).max() < 1e-8 and mine[0] == pytest.approx(loss) and np.allclose(mine[1], grad, atol=1e-12)
    for _ in range(20):
        w = r.weights + rng.normal(size=5) * 0.05
        assert plain(w)[0] > loss
        bend = quality_classifier.pair_loss(z[y == 1], z[y == 0], w)[2]
        step = rng.normal(size=5) * 1e-6
        assert np.allclose(plain(w + step)[1] - plain(w - step)[1], 2 * bend @ step, atol=1e-11)


def test_quality_scores_against_plain_features(spark, prose):
    """Scores of a frame equal the learnt line on features worked out text by text."""
    docs, labels, texts, y = labelled(spark, prose, lambda t, bad, rng: t.upper() + " ###" if bad else t + ".")
    ranker = quality_classifier.fit(docs.drop("y"), labels, "y", F.lit(True))
    # repeated rows and labels change nothing, and an id with both labels is two examples
    again = quality_classifier.fit(docs.drop("y").unionByName(docs.drop("y").limit(50)), labels.unionByName(labels.limit(80)), "y", F.lit(True))
    assert np.allclose(ranker.weights, again.weights) and ranker.cut == pytest.approx(again.cut)
    some = [*ODD, *texts[:20], "A! b? c#\nA! b? c#\n\nd e f\n", "x" * 100_000]

    def plain(text):
        t = text or ""
        raw, w, out = t.encode(), SPACED.findall(t), [0.0] * 19
        for byte in raw:
            out[quality_classifier._CLASSES[byte]] += 1 / len(raw)
        low, n = [x.translate(LOW) for x in w], len(w)
        out[10] = np.log1p(n) / 10
        if n:
            lines = [x for x in raw.split(b"\n") if x.strip()]
            out[11] = min(sum(len(x.encode()) for x in w) / n, 30) / 30
            out[12], out[14] = len(set(low)) / n, max(collections.Counter(low).values()) / n
            out[13] = 1 - len(set(zip(low, low[1:], strict=False))) / (n - 1) if n > 1 else 0.0
            out[15], out[16] = 1 - len(set(lines)) / max(len(lines), 1), min(n / max(len(lines), 1), 100) / 100
            out[17] = sum(quality_classifier._CLASSES[x.encode()[-1]] in (5, 7, 8) for x in w) / n
            up, lo = ([sum(a <= c <= z for c in x) for x in w] for a, z in ("AZ", "az"))
            out[18] = sum(u > 1 and not v for u, v in zip(up, lo, strict=True)) / n
        return out

    docs = frame(spark, some).withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in quality_classifier.classify(docs, ranker, ["doc_id", "score"]).collect()}
    want = ranker.score(np.array([plain(t) for t in some]))
    assert [got[i]._swident_score for i in range(len(some))] == pytest.approx(want.tolist(), abs=1e-9)
    assert quality_classifier.classify(docs.limit(0), ranker, ["doc_id"]).count() == 0
