"""op4, op6, op7, op8, op9 and the pipeline against plain versions, and odd inputs."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from swident.llm import decontaminate, katz, near_duplicates, pieces, warc
from swident.llm.common import held_out

DOCS = "doc_id long, text string"
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [None, "", " ", "a", "É é\n\n日本", "😀 x", "a " * 3000, "B" * 30_000]
LEXICON = ["".join(random.Random(i).choices("aeioutrsn", k=3 + i % 4)) for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(LEXICON, k=n))


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), DOCS)


# --- pieces ----------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.load_model()


TEXTS = ["", " ", "  a", "a  b   c    d ", "x\n\ny\t\r\n", "▁x▁ ▁▁y", "é漢字😀\x00z", "ab" * 300, "<s> </s> <0x41>", "Hello, world! It's 3.14 (ok)?", "naïve café—déjà vu…"]


def ids_of(p, texts, documents=None):
    keys = np.arange(len(texts), dtype=np.uint64) if documents is None else np.array(documents, dtype=np.uint64)
    return [np.frombuffer(x, np.int32).tolist() for x in p.encode_many(texts, keys)]


def test_no_dropout_equals_the_model(model):
    import sentencepiece

    own, ref = pieces.Pieces(model, 0, 0.0), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(0)
    more = ["".join(rng.choices("ab c\n.,é1-", k=rng.randint(1, 60))) for _ in range(300)]
    texts = [t for t in [*TEXTS, *more, prose(rng, 500)] if pieces.SPACE not in t]
    assert ids_of(own, texts) == [ref.encode(t) for t in texts]


def plain_agenda(p, text, document):
    """Units cut one by one: at each step the pair of the best rank, leftmost, is merged or skipped for good."""
    v, mask, out = p.v, (1 << 64) - 1, []

    def mix(h):
        for m, s in ((0xFF51AFD7ED558CCD, 33), (0xC4CEB9FE1A85EC53, 33)):
            h = (h ^ (h >> s)) * m & mask
        return h ^ (h >> 33)

    for place, unit in enumerate(p.units_of(text)):
        if unit is None:
            out += [int.from_bytes(v.byte[b], "little") for b in pieces.SPACE.encode()]
            continue
        key = mix((mix(document ^ (p.seed * pieces._STEP & mask)) + place * pieces._SALT) & mask)
        cells = [(i, [c]) for i, c in enumerate(unit)]  # place of the first character, characters
        skipped = set()
        while True:
            best = None
            for (i, x), (j, y) in zip(cells, cells[1:], strict=False):
                x, y = "".join(x), "".join(y)
                if x in v.id and y in v.id and (r := v.merge.get(v.id[x] << pieces._BITS | v.id[y])) is not None and (i, j, x + y) not in skipped:
                    best = min(best or (1 << 62, 0, 0, ""), (r, i, j, x + y))
            if best is None:
                break
            _, i, j, piece = best
            h = (key ^ (i * pieces._STEP & mask) ^ (v.id[piece] * pieces._SALT & mask)) * pieces._MIX & mask
            if (h ^ (h >> 32)) * pieces._MIX & mask < int(p.limit):
                skipped.add((i, j, piece))
                continue
            cells = [(k, list(piece) if k == i else x) for k, x in cells if k != j]
        for _, x in cells:
            x = "".join(x)
            out += [v.id[x]] if x in v.id else [int.from_bytes(v.byte[b], "little") for b in x.encode()]
    return out


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_dropout_equals_a_plain_agenda(model, monkeypatch, rate):
    monkeypatch.setattr(pieces, "NODES", 200)
    p, rng = pieces.Pieces(model, 7, rate), random.Random(6)
    texts = [*TEXTS, *ODD[1:6], prose(rng, 60), "tokenization " * 30, "é漢x" * 30, "▁hello" * 5, "x" * 49, "y" * 48]
    texts += ["".join(rng.choices("ab c\n.,é1-▁漢", k=rng.randint(1, 90))) for _ in range(60)]
    documents = [rng.getrandbits(64) for _ in texts]
    want = [plain_agenda(p, t, d) for t, d in zip(texts, documents, strict=True)]
    assert ids_of(p, texts, documents) == want
    assert [ids_of(p, [t], [d])[0] for t, d in zip(texts, documents, strict=True)] == want


def test_dropout_is_seeded_varied_and_lossless(model):
    a, b, c = pieces.Pieces(model, 1, 0.1), pieces.Pieces(model, 1, 0.1), pieces.Pieces(model, 2, 0.1)
    word, text = "internationalisation", prose(random.Random(3), 200)
    assert ids_of(a, [text]) == ids_of(b, [text]) != ids_of(c, [text])
    assert ids_of(a, [text], [0]) != ids_of(a, [text], [1])
    # one word many times: cut anew at each place of a document
    cuts = {tuple(x) for x in ids_of(a, [f"{word} " * k + word for k in range(1)] * 300)}
    assert len(cuts) > 20
    plain = pieces.Pieces(model, 0, 0.0)
    merges = lambda p, t: sum(map(len, p.units_of(t))) - len(ids_of(p, [t])[0])
    assert 0.8 < merges(a, text) / merges(plain, text) < 0.99
    # the share of skipped merges is the rate: units of one merge
    pairs = [u for u in "of to in is on at by as it an".split()]
    many = ids_of(a, [" ".join(pairs * 200)])[0]
    none = ids_of(plain, [" ".join(pairs * 200)])[0]
    assert len(none) < len(many) < 1.4 * len(none)
    for t in [*TEXTS, text]:
        for p in (a, c):
            ids = np.frombuffer(p.encode_many([t], np.zeros(1, np.uint64))[0], np.int32)
            assert p.decode_many(ids, np.array([len(ids)]))[0].decode() == t


def test_encode_frames(spark, model):
    docs = frame(spark, ODD + TEXTS).withColumns({"_n_pieces": F.lit("clash"), "_variant": F.lit("clash"), "ids": F.lit(1)})
    out = pieces.encode(docs, ["doc_id", "text", "_n_pieces", "_variant", "ids"], model, seed=9)
    back = {r.doc_id: r for r in pieces.decode(out, ["doc_id", "text", "_swident_n_pieces", "_n_pieces"], model).collect()}
    assert all(r._swident_text == r.text and r._n_pieces == "clash" for r in back.values()) and len(back) == len(ODD + TEXTS)
    assert back[0]._swident_text is None and back[0]._swident_n_pieces == 0
    again = docs.unionByName(docs).withColumn("doc_id", F.when(F.col("doc_id") > 3, F.col("doc_id")))
    made = pieces.round_trip(again, ["doc_id", "text"], model, seed=9).collect()
    assert len(made) == 2 * len(ODD + TEXTS) and all(r._swident_lossless for r in made)
    assert len({(r.doc_id, r.text, tuple(r._swident_ids or [])) for r in made}) == len(set(ODD[:4])) + len(ODD + TEXTS) - 4
    assert pieces.round_trip(docs.limit(0), ["doc_id"], model).count() == 0


# --- near duplicates -------------------------------------------------------


def sets_of(texts):
    out = []
    for t in texts:
        w = SPACED.findall((t or "").translate(LOW))
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def plain_components(texts, p=4, q=5):
    sets = sets_of(texts)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and common * q >= (len(sets[i]) + len(sets[j]) - common) * p:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(sets[i]), find(i)) for i in range(len(texts))]


def edited(rng, text, share):
    w = text.split()
    for _ in range(max(1, int(len(w) * share))):
        w[rng.randrange(len(w))] = rng.choice(LEXICON)
    return " ".join(w)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(11)
    texts = []
    passage = prose(rng, 60)
    for n in (5, 6, 7, 9, 12, 20, 33, 64, 100, 300):
        base = prose(rng, n)
        texts += [base, base.upper(), *[edited(rng, base, s) for s in (0.005, 0.01, 0.02, 0.03, 0.05)], base + " " + prose(rng, max(1, n // 9)), " ".join(base.split()[max(1, n // 8) :])]
    texts += [passage + " " + prose(rng, 40) for _ in range(60)]
    hub = prose(rng, 150)
    texts += [edited(rng, hub, rng.choice([0.01, 0.02, 0.03])) for _ in range(120)]
    texts += [*ODD, None, "", "x y", "x y", "y x", "x y z w v", "x y z w"]
    docs = frame(spark, texts).withColumn("node", F.lit("clash"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs).collect()}
    want = plain_components(texts)
    assert [got[i] for i in range(len(texts))] == want
    kept = sorted(r.doc_id for r in near_duplicates.keep_one(docs.unionByName(docs.limit(3))).collect())
    assert kept == [i for i, (n, c) in enumerate(want) if c == i]
    assert near_duplicates.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("blocks", [1 << 22, 2000])
def test_near_duplicates_with_hot_keys(spark, monkeypatch, blocks):
    """Every group salted, every join on a node or pivot with a hot side, small blocks: the same classes."""
    for name, value in (("HOT", 3), ("MOST_HOT", 10**9), ("SAMPLE", 1), ("SALTED_ROWS", 16), ("BLOCK_BYTES", blocks)):
        monkeypatch.setattr(near_duplicates, name, value)
    rng = random.Random(12)
    hub, passage = prose(rng, 150), prose(rng, 200)
    texts = [edited(rng, hub, rng.choice([0.01, 0.02, 0.03])) for _ in range(80)] + [hub] * 30
    texts += [passage + " " + prose(rng, rng.choice([30, 60, 120])) for _ in range(50)] + [prose(rng, 40) for _ in range(20)] + [None, "", "x y"]
    docs = frame(spark, texts).repartition(7)
    assert near_duplicates.frequent_keys(docs, Fraction(4, 5))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs).collect()}
    want = plain_components(texts)
    assert [got[i] for i in range(len(texts))] == want
    assert sorted(r.doc_id for r in near_duplicates.keep_one(docs).collect()) == [i for i, (n, c) in enumerate(want) if c == i]


def test_every_linking_pair_shares_a_key():
    rng = np.random.default_rng(1)
    t = Fraction(4, 5)
    for _ in range(1500):
        n = int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        keep = rng.random(len(x)) > rng.random() * 0.2
        y = np.unique(np.concatenate((x[keep], rng.integers(0, 1 << 63, int(rng.integers(0, n // 8 + 2)), dtype=np.uint64))))
        common = len(np.intersect1d(x, y))
        if len(y) and common * 5 >= (len(x) + len(y) - common) * 4:
            assert set(near_duplicates._keys(x, t).tolist()) & set(near_duplicates._keys(y, t).tolist()) or np.array_equal(x, y)
        a, b = (np.frombuffer(near_duplicates._hamming_sketch(v), np.uint8)[None, :] for v in (x, y if len(y) else x))
        w = min(a.shape[1], b.shape[1])
        apart = near_duplicates._apart(near_duplicates._folded(a, w), near_duplicates._folded(b, w))[0]
        assert apart <= len(np.setxor1d(x, y if len(y) else x))


# --- language model --------------------------------------------------------


def plain_katz(texts, learnt=lambda i: zlib.crc32(str(i).encode()) % 7 != 2):
    """Counts, base and model score of each text, and the sum of probabilities after each context."""
    words = [SPACED.findall((t or "").translate(LOW)) for t in texts]
    train = [w for i, w in enumerate(words) if learnt(i)]
    one = collections.Counter(x for w in train for x in [*w, "</s>"])
    two = collections.Counter(g for w in train for g in zip(["</s>", *w], [*w, "</s>"], strict=True))
    n, v = sum(one.values()), len(one)
    if not train:
        one["</s>"] = 1
    of = [np.array([sum(k == r for k in c.values()) for r in range(1, katz.CUT + 2)], float) for c in (one, two)]
    d1, d2 = (katz.discounts(x) for x in of)
    star = lambda k, d: k * (d[k - 1] if k <= katz.CUT else 1)
    p = {w: star(k, d1) / sum(one.values()) for w, k in one.items()}
    unseen = 1 - sum(p.values())
    if all(k > katz.CUT for k in one.values()):
        p, unseen = {w: x * n / (n + 1) for w, x in p.items()}, 1 / (n + 1)
    after = collections.defaultdict(dict)
    for (a, b), k in two.items():
        after[a][b] = star(k, d2) / (one[a] + 1)
    alpha = {a: (1 - sum(s.values())) / (1 - sum(p[b] for b in s)) for a, s in after.items()}
    single = lambda b: p.get(b, unseen)
    prob = lambda a, b: after[a][b] if b in after.get(a, {}) else alpha.get(a, 1.0) * single(b)
    out = []
    for w in words:
        score = sum(math.log10(prob(a, b)) for a, b in zip(["</s>", *w], [*w, "</s>"], strict=True))
        known = one if train else {}
        base = sum(math.log10((known.get(x, 0) + 1) / (n + v + 1)) for x in [*w, "</s>"])
        out.append((len(w) + 1, sum(x in known for x in [*w, "</s>"]), n, base, score))
    return out, {a: sum(prob(a, b) for b in [*p, "<none of them>"]) for a in alpha}


def katz_equals_plain(spark, texts, learnt, condition):
    docs = frame(spark, texts).withColumns({"score": F.lit("clash"), "p": F.lit(1), "block": F.lit("x")})
    got = {r.doc_id: r for r in katz.score(docs, condition).collect()}
    want, sums = plain_katz(texts, learnt) if learnt else plain_katz(texts)
    assert len(got) == len(texts)
    for i, e in enumerate(want):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == e[:3]
        assert r.base_score == pytest.approx(e[3], rel=1e-9, abs=1e-12) and r.score == pytest.approx(e[4], rel=1e-9)
    assert all(s == pytest.approx(1.0) for s in sums.values())
    return sums


@pytest.mark.parametrize(("tokens", "docs"), [(1_000_000, 32_768), (150, 7)])
def test_katz(spark, monkeypatch, tokens, docs):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", tokens)
    monkeypatch.setattr(katz, "BLOCK_DOCS", docs)
    rng = random.Random(8)
    texts = [prose(rng, rng.randint(1, 80)) for _ in range(150)] + ["once " + prose(rng, 5), *ODD, "the the the " * 50]
    katz_equals_plain(spark, texts, None, ~held_out(F.col("doc_id"), 7, 2))


def test_katz_of_contexts_that_saw_every_word(spark):
    """Few words, so that contexts are followed by all of them, often and seldom; all sums are 1."""
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abc", k=30)) for _ in range(40)] + ["a b c d", "d", "e e", ""]
    assert len(katz_equals_plain(spark, texts, lambda i: i < 42, F.col("doc_id") < 42)) == 5
    # no count of a word, or of a pair, is discounted
    katz_equals_plain(spark, ["a b"] * 9 + ["b a", "a c"], lambda i: i < 9, F.col("doc_id") < 9)
    # repeated rows count as often as they occur
    twice = frame(spark, ["a b c", "a b"]).unionByName(frame(spark, ["a b c", "a b"]))
    got = {(r.doc_id, round(r.score, 9), r.train_tokens) for r in katz.score(twice, F.lit(True)).collect()}
    assert got == {(i % 2, round(e[4], 9), 14) for i, e in enumerate(plain_katz(["a b c", "a b"] * 2, lambda i: True)[0])}


def test_katz_keeps_every_word(spark):
    """Words met once have bigrams and backoff weights of their own."""
    katz_equals_plain(spark, ["rare word pair", "other term here", "more text there", "rare word here"] + ["filler text"] * 3, lambda i: i != 3, F.col("doc_id") != 3)


def test_katz_on_nothing(spark):
    docs = frame(spark, ODD)
    got = katz.score(docs, F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in got} == {(0, 0, 0.0)} and len(got) == len(ODD)
    assert katz.score(docs.limit(0), F.lit(True)).count() == 0


# --- decontamination -------------------------------------------------------


@pytest.mark.parametrize("fits", [True, False])
def test_decontamination(spark, monkeypatch, fits):
    monkeypatch.setattr(decontaminate, "fits", lambda df: fits)
    rng = random.Random(21)
    items = [prose(rng, n) for n in (30, 12, 10, 9, 3, 1)] + [None, "", ".,;", "É wort " * 6, "the the the the the the the the the the the"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(0, items[0]), (None, prose(rng, 11))], "item_id long, text string")
    texts = [prose(rng, 200) for _ in range(30)]
    texts += [prose(rng, 20) + " " + items[0].upper() + ", " + prose(rng, 9), items[1], items[2][: items[2].rindex(" ")], prose(rng, 4) + ";" + items[3] + "!" + items[3], "x " + items[4], items[0].replace(" ", "\n--\n") * 40]
    texts += ["é wort " * 6, "É WORT " * 6, "the " * 500, " ".join(items[0].split()[3:20] + items[1].split()), *ODD]
    docs = frame(spark, texts).withColumns({"n_hit": F.lit("clash"), "doc": F.lit("clash"), "term": F.lit(1), "pos": F.lit(2)})
    docs = docs.unionByName(docs.where("doc_id in (30, 31)"))
    rows = [(str(i), t) for i, t in enumerate(items)] + [("", bench.where("item_id is null").first().text)]
    got = collections.defaultdict(list)
    for r in decontaminate.contamination(docs, bench).collect():
        got[r.doc_id].append((r.n_words, r.n_hit, r.items, r.contaminated))
    for i, t in enumerate(texts):
        w, hit, found = ALNUM.findall((t or "").translate(LOW)), set(), set()
        for item, text in rows:
            x = ALNUM.findall((text or "").translate(LOW))
            n = min(10, len(x))
            for a in range(len(x) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b : b + n] == x[a : a + n]:
                        hit |= set(range(b, b + n))
                        found.add(item)
        assert got[i] == [(len(w), len(hit), sorted(found), bool(hit))] * (2 if i in (30, 31) else 1), (i, t)
    clean = sorted(r.doc_id for r in decontaminate.keep_clean(docs, bench).collect())
    assert clean == [i for i in range(len(texts)) if not got[i][0][3]]
    matches = [tuple(r) for r in decontaminate.find_matches(docs, bench).collect()]
    assert {(i, b) for i, b, kind, *_ in matches if kind == "phrase"} == {(i, b) for i in got for b in got[i][0][2]}
    for i, b, kind, start, end in matches:
        w = ALNUM.findall((texts[i] or "").translate(LOW))[start : end + 1]
        x = [ALNUM.findall((t or "").translate(LOW)) for j, t in rows if j == b]
        assert any(" ".join(w) in " ".join(y) for y in x) if kind == "phrase" else 1 < len(w) <= 10 and any({w[0], w[-1]} <= set(y) for y in x)
    # a passage with other words between: no phrase, but its rare words are near each other
    broken = frame(spark, [items[0].replace(" ", " zz ", 40), prose(rng, 50)])
    kinds = {(r.doc_id, r.kind) for r in decontaminate.find_matches(broken, bench.where("item_id = 0")).collect()}
    assert (0, "proximity") in kinds and (0, "phrase") not in kinds
    for a, b in ((docs.limit(0), bench), (docs, bench.limit(0))):
        assert decontaminate.contamination(a, b).where("contaminated").count() == 0


def test_decontamination_is_native(spark):
    docs, bench = frame(spark, ["a b c"]), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontaminate.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- archives --------------------------------------------------------------


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives(spark, tmp_path, compression):
    rows = [(1, "http://a/ b", "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n" * 20), (2, None, None), (3, "u\r\nEvil: 1", ""), (4, "u", "é漢" * 300), (5, "u", "é漢" * 300), (None, "u", "zz\r"), (6, "u", "end\r\n"), (6, "u", "end\r\n"), (7, "u", "q" * 200_000), (8, "u", "\n\n"), (9, "u", "WARC/1.0\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"sha1": F.lit(1), "archive": F.lit("clash"), "first": F.lit(2)})
    warc.write_warc(pages, str(tmp_path / "w"), 128, compression)
    chunks = warc.read_chunks(spark, str(tmp_path / "w"), chunk_bytes=100).collect()
    assert max(c.n_bytes for c in chunks) <= 100
    parts = collections.defaultdict(list)
    for c in sorted(chunks, key=lambda c: (c.archive, c.record_no, c.chunk_no)):
        parts[c.archive, c.record_no].append(c)
    for group in parts.values():
        so_far = b""
        assert [c.chunk_no for c in group] == list(range(len(group)))
        for c in group:
            so_far += bytes(c.data)
            assert c.running_digest == base64.b32encode(hashlib.sha1(so_far).digest()).decode()
        if group[0].record_type == "response":
            assert so_far in [(h or "").encode() for _, _, h in rows]
    out = warc.resolved(warc.records(warc.read_chunks(spark, str(tmp_path / "w")))).collect()
    assert len(out) == len(rows) and all(r.intact for r in out)
    got = sorted((r.page_id or "", r.record_type, r.payload_bytes, r.refers_to or "") for r in out)
    assert got == sorted([("1", "response", 720, ""), ("2", "response", 0, ""), ("3", "revisit", 0, "2"), ("4", "response", 1500, ""), ("5", "revisit", 1500, "4"), ("", "response", 3, ""), ("6", "response", 5, ""), ("6", "response", 5, ""), ("7", "response", 200_000, ""), ("8", "response", 2, ""), ("9", "response", 9, "")])
    by = {r.page_id: r for r in out}
    assert by["5"].payload_digest == by["4"].payload_digest == base64.b32encode(hashlib.sha1(("é漢" * 300).encode()).digest()).decode()
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_plain_archives_over_many_splits(spark, tmp_path):
    rng = random.Random(4)
    pages = spark.createDataFrame([(i, "u", prose(rng, rng.randint(0, 900)).replace("a", "\n")) for i in range(300)], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(pages, str(tmp_path / "w"), compression="none")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = spark.read.text(str(tmp_path / "w"))
        assert lines.rdd.getNumPartitions() > 8
        out = {int(r.page_id): r for r in warc.records(warc.read_chunks(spark, str(tmp_path / "w"))).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(out) == 300
    for p in pages.collect():
        data = p.html.encode()
        assert (out[p.page_id].read_bytes, out[p.page_id].read_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())


def record(kind, data, **more):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{len(data)}>", *(f"{k}: {v}" for k, v in more.items()), f"Content-Length: {len(data)}"]
    return "WARC/1.1\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + data + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """Binary payloads, records of other kinds, no HTTP header, noise between records, an end too early."""
    noise = random.Random(1).randbytes(50_000)
    http = b"HTTP/1.0 200 OK\nX: y\n\n"
    data = record("warcinfo", b"software: x\r\n") + b"\r\nnoise\r\n" + record("response", http + noise, **{"Content-Type": "application/http; msgtype=response"}) + record("resource", noise[:777]) + record("response", b"") + record("resource", noise)[:-100]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(data)
    got = sorted((r.record_no, r.record_type, r.read_bytes, r.read_digest) for r in warc.records(warc.read_chunks(spark, str(tmp_path / "w"), chunk_bytes=1000)).collect())
    digest = lambda x: base64.b32encode(hashlib.sha1(x).digest()).decode()
    assert got[:4] == [(0, "warcinfo", 13, digest(b"software: x\r\n")), (1, "response", 50_000, digest(noise)), (2, "resource", 777, digest(noise[:777])), (3, "response", 0, digest(b""))]
    assert got[4][:2] == (4, "resource") and 49_900 <= got[4][2] < 50_000


def test_a_record_of_100_mb_is_held_by_chunks():
    """One unsegmented record, never more than a chunk and a line of it in memory."""
    import tracemalloc

    parser, line, total = warc._Parser(65_536), b"x" * 9_999, 100_000_000
    head = [b"WARC/1.0", b"WARC-Type: resource", b"Content-Length: %d" % total, b""]
    tracemalloc.start()
    n = sizes = 0
    last = None
    for x in [*head, *([line] * (total // 10_000)), b"", b""]:
        for _, record_no, chunk, data, last, _ in [*parser.enter("a"), *parser.line(x)]:
            assert record_no == 0 and chunk == n and len(data) <= 65_536
            n, sizes = n + 1, sizes + len(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sizes == total and peak < 2_000_000
    want = hashlib.sha1()
    for _ in range(total // 10_000):
        want.update(line + b"\n")
    assert last == base64.b32encode(want.digest()).decode()
    long = warc._Parser(1000)
    rows = [r for x in (b"WARC/1.0", b"Content-Length: 25000", b"", b"y" * 25_000) for r in long.line(x)]
    assert [len(r[3]) for r in rows] == [1000] * 25


# --- pipeline --------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(30)
    bench = [prose(rng, 30) for _ in range(3)]
    rows, labels = [], []
    for i in range(240):
        t, kind = prose(rng, 70) + ".", i % 12
        if kind == 0:
            t = " ".join(w if j % 9 else "doof" for j, w in enumerate(t.split()))
        elif kind == 1:
            t = t.replace(" ", "### ")
        elif kind == 2 and i > 24:
            t = edited(rng, rows[i - 24][1], 0.001) if i % 24 == 2 else rows[i - 24][1]
        elif kind == 3:
            t = t + " " + bench[i % 3]
        rows.append((i, t, "en", "s", len(t)))
        labels.append((i, int(kind != 1), int(kind == 0)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left.append({r.doc_id for r in docs.collect()})
    ids = set(range(240))
    assert ids - left[0] == {i for i in ids if i % 12 == 0}
    assert left[0] - left[1] - {1000, 1001} == {i for i in ids if i % 12 == 1}
    want = {c for i, (n, c) in zip(sorted(left[1] & ids), plain_components([rows[i][1] for i in sorted(left[1] & ids)]), strict=True) for c in [sorted(left[1] & ids)[c]]}
    assert left[2] & ids == want
    assert left[2] - left[3] == {i for i in left[2] & ids if i % 12 == 3}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == left[3] and all(r.n_pieces == len(r.ids or []) for r in out)


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Extra columns with clashing names, repeated rows, no labels, no benchmark; then no documents."""
    names = ("node", "kept", "first", "doc", "y", "_id", "score", "n", "key", "_hash", "rank", "sketch")
    texts = [*ODD, prose(random.Random(1), 40), "x y z"]
    docs = frame(spark, texts).selectExpr("doc_id", "text", "'en' as lang", "cast(null as string) as source", "length(text) as n_chars").withColumns({n: F.lit("clash") for n in names})
    docs = docs.unionByName(docs.limit(5)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    for k, rows in enumerate((docs, docs.limit(0))):
        at = str(tmp_path / str(k))
        rows.write.parquet(f"{at}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
        out = corpus_pipeline.run(spark, at).collect()
        assert all(r.lossless for r in out)
        kept = {r.doc_id for r in out if r.doc_id is not None}
        # texts without words all stay, of the others one of each class
        words = [i for i, (n, _) in enumerate(plain_components(texts)) if n]
        want = {i for i, (n, c) in enumerate(plain_components(texts)) if c == i or not n}
        assert kept == (want if k == 0 else set()) and (k or set(words) & kept)
