"""The ten operators and the pipeline against brute force on small fixtures."""

import hashlib
import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallygrove.llm import exact_dedup as ed
from tallygrove.llm import hmm_lm, html_extract, langid, line_dedup, packing, pieces, quality, simhash, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, word string"
TEXTS = ["the cat sat on the mat today", None, "", "the cat sat on the mat today", "Ärger über é漢字 und mehr", "x", "a b", "  \n\t ", "w " * 9000, "the cat sat on the mat today!"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 2}", len(t or ""), "clash", "clash") for i, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[3], "en", "s1", 28, "c", "c"), (None, "x", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def exact_want(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return Counter((r["doc_id"], keep[r["text"] or ""], len(groups[r["text"] or ""]), hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in rows)


@pytest.mark.parametrize("collide", [False, True])
def test_exact(spark, docs, empty, collide):
    def same(c):
        zero = F.lit(0).cast("long")
        return F.struct(zero.alias("a"), zero.alias("b"), zero.alias("n"))

    got = ed.exact_dedup(docs, fingerprint=same if collide else None).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == exact_want(docs.collect())
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(exact_want(docs.collect()).keys() and {k[3] for k in exact_want(docs.collect())})
    assert ed.exact_dedup(empty).collect() == []


def test_exact_late_difference(spark):
    """Under a forced collision, texts of equal length that differ in a late chunk only are told apart."""
    long = "abcdefgh" * 5000
    late = long[:-3] + "x" + long[-2:]
    rows = [(1, long), (2, late), (3, long), (4, late), (5, late[:-1] + "y")]
    zero = F.lit(0).cast("long")
    clash = lambda c: F.struct(zero.alias("a"), zero.alias("b"), zero.alias("n"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for fingerprint in (None, clash):
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in ed.exact_dedup(frame, fingerprint=fingerprint).collect()}
        assert got == {1: (3, 2, False), 2: (4, 2, False), 3: (3, 2, True), 4: (4, 2, True), 5: (5, 1, True)}


def test_fingerprints_compose(spark):
    data = bytes(random.Random(1).randbytes(50_000))
    h = ed.Hasher()
    whole = h.hash(data)
    for cut in (0, 1, 8192, 20_001, 50_000):
        left, right = h.hash(data[:cut]), h.hash(data[cut:])
        assert ed.combine(left[0], right[0], right[1]) == whole[0]
    slow = [0] * 4
    for b in data[:300]:
        slow = [(s * base + b) % ed.PRIME for s, base in zip(slow, ed.BASES)]
    assert h.hash(data[:300])[0] == slow
    text = "abc déf " * 5000
    chunks = spark.createDataFrame([(1, k, text[i : i + 7000]) for k, i in enumerate(range(0, len(text), 7000))], "doc_id int, chunk int, text string")
    fp = ed.combine_fingerprints(ed.chunk_fingerprints(chunks)).first()["fp"]
    (a, b, c, d), n = h.hash(text.encode())
    assert (fp["a"], fp["b"], fp["n"]) == (a << 31 | b, c << 31 | d, n)


def slow_simhash(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(spark, docs, empty):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    values = base + [b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for b in base] + [0, 7]
    got = {}
    half = np.array(values[:70], np.uint64), np.array(values[70:], np.uint64)
    forests = simhash.link_blocks(half[0], None) + simhash.link_blocks(half[1], None) + simhash.link_blocks(*half)
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in forests:
        parent[find(a % 2**64)] = find(b % 2**64)
    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 3:
            assert find(a) == find(b)
            got[a] = b
    assert len(got) >= 60 and len({find(v) for v in values}) == 61
    rows = docs.collect()
    told = simhash.near_dedup(docs).collect()
    fps = {r["doc_id"]: slow_simhash(r["text"]) for r in rows}
    assert all(int(r["fingerprint"], 16) == fps[r["doc_id"]] for r in told) and len(told) == len(rows)
    comp = {r["doc_id"]: r["component_id"] for r in told}
    for a, b in itertools.combinations([i for i in fps if i is not None], 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            assert comp[a] == comp[b]
    assert comp[1] == 1 and comp[2] == 1 and comp[7] == 1 and comp[None] == 5
    assert simhash.near_dedup(empty).collect() == []


def test_simhash_split_blocks(spark):
    """Blocks forced down to a few nodes, so that one population count has several: the same components as brute force."""
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(60)]
    rows, texts = [], []
    for i in range(400):
        base = rng.choice(texts).split() if texts and rng.random() < 0.5 else rng.choices(words, k=rng.randint(1, 120))
        if rng.random() < 0.7 and len(base) > 3:
            base[rng.randrange(len(base))] = rng.choice(words)
        texts.append(" ".join(base))
        rows.append((i, texts[-1]))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    fps = {i: slow_simhash(t) for i, t in rows}
    parent = dict.fromkeys(fps)

    def find(x):
        while parent[x] is not None:
            x = parent[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3 and find(a) != find(b):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    want = {i: find(i) for i in fps}
    assert len(set(want.values())) < 390
    for least, most in ((1 << 14, 1 << 20), (4, 4)):
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_dedup(frame, least_block=least, most_block=most).collect()}
        assert got == want
    counts = Counter(v.bit_count() for v in fps.values())
    nodes = frame.select(simhash.fingerprint_udf()("text").alias("fp")).distinct().select("fp", F.bit_count("fp").alias("pc"))
    assert max(counts.values()) > 8 and simhash.block_pairs(nodes, 4, 4).select("pair").distinct().count() > simhash.block_pairs(nodes).select("pair").distinct().count()


def test_langid(spark, docs, empty):
    rng = random.Random(5)
    words = {"en": ["the", "and", "house", "thing", "with"], "de": ["der", "und", "schön", "ich", "straße"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=30)), lang) for i in range(80) for lang in ("en", "de")]
    model = langid.train(spark.createDataFrame(rows[:100], "i int, text string, lang string"))
    told = langid.identify(spark.createDataFrame(rows[100:], "doc_id int, text string, lang string"), model).collect()
    want = [r[2] for r in rows[100:]]
    assert [r["lang_pred"] for r in told] == want and all(0 <= r["score"] <= 1 for r in told)
    und = {r["doc_id"] for r in langid.identify(docs, model).collect() if r["lang_pred"] == "und"}
    assert und == {1, 2, 7}
    assert langid.train(empty) is None and langid.identify(empty, None).collect() == []
    signs = spark.createDataFrame([(1, "½ ²"), (2, "12 ½ a")], "doc_id int, text string")
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in langid.identify(signs, model).collect()} == {1: True, 2: False}
    row = np.zeros(langid.BUCKETS)
    langid.mark("Ab", row)
    assert row.sum() == 3  # a, b, ab


def test_langid_kernel():
    """The batched product against the kernel with landmarks, written out with sets of n-grams."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("abc de", k=rng.randint(5, 30))) for _ in range(40)]
    langs = ["x" if t.count("a") > t.count("b") else "y" for t in texts]

    def grams(t):
        row = np.zeros(langid.BUCKETS, np.uint8)
        langid.mark(t, row)
        return row

    def kernel(a, b):
        x, y = set(np.flatnonzero(grams(a)).tolist()), set(np.flatnonzero(grams(b)).tolist())
        return len(x & y) / math.sqrt(len(x) * len(y))

    model = langid.fit([np.packbits(grams(t)).tobytes() for t in texts], langs)
    marks = [t for k, t in enumerate(texts) if langs[:k].count(langs[k]) < langid.LANDMARKS // 2]
    k_nm = np.array([[kernel(t, m) for m in marks] for t in texts])
    k_mm = np.array([[kernel(t, m) for m in marks] for t in marks])
    y = np.array([[1.0 if lang == n else -1.0 for n in "xy"] for lang in langs])
    alpha = np.linalg.solve(k_nm.T @ k_nm + langid.RIDGE * len(texts) * k_mm + 1e-8 * len(texts) * np.eye(len(marks)), k_nm.T @ y)
    new = ["cab dab", "bbbb e", "acdc"]
    want = np.array([[kernel(t, m) for m in marks] for t in new]) @ alpha
    got = model.scores(np.stack([grams(t) for t in new]).astype(np.float32))
    assert model.langs == ["x", "y"] and np.allclose(got, want, atol=2e-3)


def test_langid_sample(spark):
    """Copies neither shrink nor fill the sample; a language of few texts is learned, and so is the 600th."""
    rows = [("the same text again", "en")] * 3000 + [(f"house and thing {i}", "en") for i in range(40)] + [(f"haus und ding {i}", "de") for i in range(3)]
    rows += [(f"wort{i} " * 4, f"l{i:03}") for i in range(600)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), per_lang=20)
    assert len(model.langs) == 602


def slow_stats(text):
    words = [w.decode() for w in (text or "").encode().split()]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    at = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(at)


def test_quality(spark, empty):
    texts = [*TEXTS[:8], "a b c a b c\na b c", "x x x x x x", "l1 # $\nl1 # $\n \nq", "a b c d a b c e", "v w x y z v w x w x y"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, words int")
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.statistics(docs).collect()}
    assert got == {i: slow_stats(t) for i, t in enumerate(texts)}
    rng = random.Random(1)
    rows = [{"n_words": 100.0, "word_length": rng.uniform(4, 6), "symbol_ratio": (s := rng.uniform(0, 1)), "dup_line_ratio": 0.0, "repeat_ratio": 0.1, "bad": s > 0.6} for _ in range(300)]
    rules = quality.learn(rows)
    assert rules and all(any(quality._covers(r, x) for r in rules) == x["bad"] for x in rows if abs(x["symbol_ratio"] - 0.6) > 0.03)
    assert quality.learn([]) == [] and quality.learn([r | {"bad": False} for r in rows]) == []
    long = spark.createDataFrame([(1, " ".join(f"w{i}#" for i in range(60))), (2, " ".join(f"w{i}" for i in range(60))), (3, None)], "doc_id int, text string")
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality.assess(long, rules).collect()}
    assert kept == {1: (False, False), 2: (False, True), 3: (True, False)}
    assert quality.assess(empty, rules).collect() == []


def slow_kind(clause):
    """The kind of a clause by the rules in words, without a machine."""
    negated = [any(x == "N" for x in clause[max(0, i - toxicity.REACH) : i]) for i in range(len(clause))]
    insults = {clause[i] for i in range(len(clause)) if clause[i] in "IW" and not negated[i]}
    softened = {clause[i] for i in range(len(clause)) if clause[i] in "IW" and negated[i]}
    threats = [i for i in range(len(clause)) if clause[i] == "T" and not negated[i]]
    threat = any("O" in clause[i:] or "P" in clause[i:] or "P" in clause[:i] for i in threats)
    if "R" in clause:
        return "reported" if threat or insults else "negated" if softened else None
    if threat:
        return "threat"
    if "I" in insults:
        return "targeted" if set(clause) & set("UOP") else "plain"
    return "weak" if insults else "negated" if softened else None


def test_quality_labels(spark):
    """Null labels are left out, the lower of repeated ones counts, a repeated document counts once, the bound holds."""
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    docs = spark.createDataFrame([(i, text(i)) for i in range(10)] + [(3, text(3) + " more"), (None, text(99))], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (3, 1), (4, 1), (4, 0), (None, 0), (77, 0)], "doc_id bigint, quality int")
    assert [(r["bad"], r["n_words"]) for r in quality.labelled_rows(docs, labels)] == [(False, 60), (True, 60), (False, 60), (True, 60)]
    assert len(quality.labelled_rows(docs, labels, most=2)) <= 2
    assert quality.labelled_rows(docs, labels.limit(0)) == []


def test_toxicity_machine():
    """The composed machine against the rules in words and against its parts one after another, over all short strings."""
    parts = [toxicity._negation()]
    for make in (toxicity._report, toxicity._target, toxicity._clause):
        parts.append(make(sorted({o for row in parts[-1].arcs for o, _ in row.values()} | {"o"})))
    for n in range(1, 6):
        for clause in itertools.product("IWTUOPNRo" if n < 5 else "IWTOPNR", repeat=n):
            line = [*clause, "."]
            got = toxicity.MACHINE.run(line)
            if n < 4:
                want = line
                for part in parts:
                    want = part.run(want)
                assert got == want
            assert got[-1] == (slow_kind("".join(clause)) or "o"), clause
            assert set(got[:-1]) <= {"o"}
    for clause in itertools.product("INo", repeat=8):
        assert toxicity.MACHINE.run([*clause, "."])[-1] == (slow_kind("".join(clause)) or "o"), clause
    assert toxicity.match("IU.I.oTo.NoI.RI.I.TO") == Counter(targeted=1, plain=2, negated=1, reported=1, threat=1)


def test_toxicity_sentences():
    insults = {"=" + w + e: True for w in toxicity.INSULTS for e in toxicity.ENDINGS}
    grammar = toxicity.Grammar(insults, {"plain": 3.0, "targeted": 3.5, "negated": 1.0, "reported": 0.5, "weak": 1.0, "threat": 3.5}, -2.5)
    score = grammar.scorer()
    for text in ("kill you", "hurt them", "I will destroy her", "I will kill you all", "ich werde dich töten", "idiot, you", "you losers"):
        assert score(text) > 0.5, text
    for text in ("", "The distance was more than we could travel.", "a moral and worthy path", "close the window", '"idiot", he said', "never hurt them", "you are not an idiot", "they kill time"):
        assert score(text) < 0.5, text
    assert score("idiot, you. you idiot") > score("idiot, you") == score("you idiot moron scum")  # clauses count, not words


def test_toxicity(spark, docs, empty):
    rng = random.Random(2)
    words = ["house", "tree", "is", "by", "river"]
    own = ["zorgling", "zorglet", "zorglum", "zorglak"]
    rows = [(i, " ".join([*rng.choices(words, k=20), *(rng.sample(own, 2) if i % 4 == 0 else [])]), int(i % 4 == 0)) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, toxic int")
    labels = frame.where("doc_id < 150").select("doc_id", "toxic")
    more = spark.createDataFrame([(None, 1), (3, None), (0, 0), (0, 1), (4, 0)], "doc_id int, toxic int")  # the higher of repeated labels counts
    grammar = toxicity.train(frame.select("doc_id", "text"), labels.unionByName(more))
    told = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(frame, grammar).collect()}
    assert told == {i: y for i, _, y in rows}
    assert "zorgl" in grammar.insults and not any(len(u) < 5 for u in grammar.insults if not u.startswith("="))
    score = grammar.scorer()
    assert score("a zorglish house") > 0.5 > score("The distance was more than we could travel.") and score("kill you") > 0.5
    blank = toxicity.train(empty, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert all(0 <= r["score"] <= 1 for r in toxicity.toxicity(docs, blank).collect()) and toxicity.toxicity(empty, blank).collect() == []


def slow_bfd(lengths, limit):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, b in enumerate(bins) if b >= n]
        if fit:
            i = min(fit, key=lambda k: bins[k])
            bins[i] -= n
        else:
            bins.append(limit - n)
    return sorted(bins)


def test_best_fit_plan():
    rng = random.Random(4)
    for _ in range(30):
        limit = rng.randint(5, 60)
        lengths = [rng.randint(1, limit) for _ in range(rng.randint(0, 200))]
        used, seen = Counter(), set()
        for length, rank, n, first, each, offset in packing.best_fit_plan(Counter(lengths), limit):
            for k in range(n):
                b, at = first + k // each, offset + k % each * length
                assert used[b] == at
                used[b] += length
                seen.add((length, rank + k))
        assert len(seen) == len(lengths) and sorted(limit - u for u in used.values()) == slow_bfd(lengths, limit)


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    more = [(50, "x <|startoftext|> y", "en", "s", 1, "", ""), (51, "A<|endoftext|>B. <|ENDOFTEXT|> C<|endoftext|>.", "en", "s", 1, "", "")]
    docs = docs.unionByName(spark.createDataFrame(more, SCHEMA))
    assert len(t.encode("x <|startoftext|> y", add_special_tokens=False).ids) == 3
    got = packing.pack_documents(docs, limit=64).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], set()).add((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    import zlib

    for r in docs.collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want = {(k, i, len(ids[i : i + 64]), zlib.crc32(np.array(ids[i : i + 64], "<u4").tobytes())) for k, i in enumerate(range(0, len(ids), 64))}
        assert by_doc[r["doc_id"]] == want
    for _, own in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    assert packing.pack_documents(empty).collect() == []


def test_pieces(spark, docs, empty):
    model = pieces.Pieces.load(pieces.default_model())

    def paths(c, at=0):
        if at == len(c):
            yield 0.0
            return
        for b in range(1, len(c) + 1):
            for a, s, _ in model.edges(c, b):
                if a == at:
                    yield from (s + x for x in paths(c, b))

    for chunk in ("▁hello", "▁theand.", "é漢x", "▁▁on", "a"):
        want = sorted(paths(chunk), reverse=True)[:4]
        assert [s for s, _ in model.search(chunk)] == pytest.approx(want)
        best = model.entry(chunk)
        assert best[0] == pytest.approx(want[0]) and (len(want) < 2 or best[0] - best[2] == pytest.approx(want[1]))
    text = "to on é"
    whole = sorted(paths("▁to▁on▁é"), reverse=True)[:4]
    assert [s for s, _ in model.encode(text)] == pytest.approx(whole)
    coded = pieces.encode_documents(docs)
    back = {(r["doc_id"], r["text"]) for r in pieces.decode_documents(coded).collect()}
    assert back == {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    assert pieces.encode_documents(empty).collect() == []


def test_pieces_without_spaces():
    """Long chunks: back-pointers keep memory in proportion, and the paths are those of the lattice."""
    import tracemalloc

    model = pieces.Pieces.load(pieces.default_model())
    rng = random.Random(8)
    for text in ("a" * 100_000, "".join(rng.choices("etaoinshrdlu", k=100_000))):
        tracemalloc.start()
        found = model.encode(text)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 120_000_000 and len(found) == 4
        scores = [s for s, _ in found]
        assert scores == sorted(scores, reverse=True) and len({ids for _, ids in found}) == 4
        for score, raw in found:
            ids = np.frombuffer(raw, "<u4").tolist()
            assert model.decode(ids) == text and sum(model.scores[i] for i in ids) == pytest.approx(score)


def test_line_dedup(spark, empty):
    pages = [(i, f"own {i}\nmenu \n\nown {i}" if i < 9 else f"own {i}", "h1" if i < 12 else None, 7, "x") for i in range(14)] + [(20, None, "h1", 7, "x")]
    df = spark.createDataFrame(pages, "doc_id int, text string, source string, n_lines int, key string")
    for limit in (0, 1 << 20):
        got = {r["doc_id"]: r for r in line_dedup.drop_boilerplate(df, broadcast_bytes=limit).collect()}
        assert {i: (r["text"], r["n_dropped"], r["n_lines"], r["key"]) for i, r in got.items() if i in (0, 13, 20)} == {
            0: ("own 0\n\nown 0", 1, 4, "x"), 13: ("own 13", 0, 1, "x"), 20: (None, 0, 1, "x")
        }
    kept = line_dedup.drop_boilerplate(df, report=None)
    assert kept.columns == df.columns and {r["n_lines"] for r in kept.collect()} == {7}
    assert line_dedup.drop_boilerplate(empty).collect() == []


def test_line_dedup_bounds(spark):
    """A ratio at the bound keeps the line; copies of a page are one page; a page's repeated line counts once."""
    at = [(i, "line\nline" if i < 6 else f"p{i}", "a") for i in range(60)]
    at = [(i, t + f"\nq{i}" if i < 6 else t, s) for i, t, s in at]
    over = [(100 + i, f"line\nq{i}" if i < 7 else f"p{i}", "b") for i in range(60)]
    copies = [(200 + i, "same page\nwhole" if i < 40 else f"p{i}", "c") for i in range(60)]
    df = spark.createDataFrame(at + over + copies, "doc_id int, text string, source string")
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.drop_boilerplate(df, max_ratio=0.1, min_pages=5).collect()}
    assert {i for i, n in got.items() if n} == {100 + i for i in range(7)} and len(got) == 180


def test_html():
    tree = html_extract.grow(html_extract.labelled())
    unseen = html_extract.labelled(200, seed=99)
    assert sum(html_extract.decide(tree, r[:-1]) == r[-1] for r in unseen) > 0.99 * len(unseen)
    used = set()

    def walk(t):
        if not isinstance(t, int):
            used.add(html_extract.FEATURES[t[0]])
            walk(t[2])
            walk(t[3])

    walk(tree)
    assert {"words", "links", "words_after", "links_before"} <= used and tree[0] < 6
    page = (
        '<html><head><title>T</title><script>var a="</p>";</script></head><body><header>Site</header><nav><a href=x>Home</a></nav><div class="cookie-notice">We use</div>'
        '<article><h1>A &amp; B</h1><p>one  two<br>three<p>four</p><section id=comments><p>nice</p></section></article><aside>more</aside><form>q</form><!-- x'
    )
    assert html_extract.main_text(page, tree) == "A & B one two three four"
    plain = "<div><p>" + "word " * 60 + "</p><p>tail of it</p></div><ul><li><a href=a>x</a><li><a href=b>y</a></ul>"
    assert html_extract.main_text(plain, tree) == " ".join(["word"] * 60) + " tail of it"
    assert html_extract.main_text("", tree) == ""


def test_html_names_are_whole():
    """A class or id counts only if it is a name of boilerplate through and through, and never for what holds the article."""
    tree = html_extract.grow(html_extract.labelled())
    long = "<p>" + "word " * 60 + "</p><p>some more words of it here</p>"
    want = " ".join(["word"] * 60) + " some more words of it here"
    for opened in ('<div class="content no-sidebar">', '<div class="content-with-sidebar">', '<div class="site has-header-image">', '<section id="search-algorithms">', '<div class="post-ad-free">'):
        closed = "</" + opened[1:].split()[0] + ">"
        assert html_extract.main_text(f"{opened}<article>{long}</article>{closed}", tree) == want, opened
        assert html_extract.main_text(f"<article>{opened}{long}{closed}</article>", tree) == want, opened
        assert html_extract.main_text(f"<nav><a>x</a></nav><div>{opened}{long}{closed}</div><footer>c</footer>", tree) == want, opened
    for part in ('<p id="related-work">one two three</p>', '<div class="entry-header"><h1>one two three</h1></div>'):
        assert html_extract.main_text(f"<article>{long}{part}</article>", tree) == want + " one two three"
    for holds in ('<div class="sidebar">', "<form>", '<div id=search role="banner">'):
        assert html_extract.main_text(f"{holds}<article>{long}</article>", tree) == want, holds
    for gone in ('<div class="sidebar">', '<div class="x ad">', '<div class="cookie-notice">', '<section id="comments"><div>', '<div role=complementary>'):
        assert html_extract.main_text(f"<article>{long}</article>{gone}{long}</div>", tree) == want, gone
        assert html_extract.main_text(f"<article>{long}{gone}<p>nice one</p></div></article>", tree) == want, gone


def test_html_describes_and_decides():
    """Each block's features from its own words and its neighbours', and a tree walked by hand."""
    page = '<nav><a>a b</a></nav><article><h2>c</h2><p>d <a>e f</a> g</p></article><div class="ad">h</div>'
    found = html_extract.blocks(page)
    assert [b[0] for b in found] == ["a b", "c", "d e f g", "h"]
    assert html_extract.describe(found) == [
        [2, 1.0, 0, 0.0, 1, 0.0, 0.0, 1.0, 1.0, 0.0],
        [1, 0.0, 2, 1.0, 4, 0.5, 1.0, 1.0, 0.0, 1.0],
        [4, 0.5, 1, 0.0, 1, 0.0, 1.0, 1.0, 0.0, 0.0],
        [1, 0.0, 4, 0.5, 0, 0.0, 0.0, 1.0, 1.0, 0.0],
    ]
    tree = (0, 2.5, (6, 0.5, 0, (3, 0.25, 0, 1)), 1)
    assert [html_extract.decide(tree, r) for r in html_extract.describe(found)] == [0, 1, 1, 0]
    rows = [(*[float(i == j) * v for i in range(10)], label) for j, v, label in [(0, 3, 1)] * 5 + [(0, 9, 0)] * 5 + [(4, 1, 0)] * 5]
    grown = html_extract.grow(rows)
    assert [html_extract.decide(grown, r[:-1]) for r in rows] == [r[-1] for r in rows]


def test_html_tree_needs_more_than_flags():
    """On pages it has not seen, flags alone and own words alone do worse than all features, so text and neighbours decide."""
    unseen, table = html_extract.labelled(300, seed=99), html_extract.labelled()
    score = lambda tree: sum(html_extract.decide(tree, r[:-1]) == r[-1] for r in unseen) / len(unseen)
    whole, flags, alone = score(html_extract.grow(table)), score(html_extract.grow(table, features=range(6, 10))), score(html_extract.grow(table, features=[0, 1, 6, 7, 8, 9]))
    assert whole > 0.995 and flags < 0.95 and alone < whole - 0.005


def test_html_hidden():
    """Only what is really hidden goes: a value with the word in it hides nothing."""
    tree = html_extract.grow(html_extract.labelled())
    text = lambda attributes: html_extract.main_text(f"<article><div {attributes}><p>one two three</p></div></article>", tree)
    for shown in ('style="overflow:hidden"', 'title="The hidden valley"', 'data-x="hidden"', "data-x=hidden", 'aria-hidden="false"', 'style="x-display:none"', 'title="display:none"', "data-class=nav"):
        assert text(shown) == "one two three", shown
    for gone in ("hidden", 'hidden=""', "HIDDEN", 'aria-hidden="true"', "style='color:red; display : none'", 'style="visibility:hidden !important;"', 'class="nav"'):
        assert text(gone) == "", gone
    long = "<article><p>" + "word " * 100_000 + "</p><p>x</p></article><footer>" + "end " * 500 + "</footer>"
    assert html_extract.main_text(long, tree) == " ".join(["word"] * 100_000) + " x"
    drawn = "<article><p>a <svg><text>b</text></svg> <canvas>c</canvas><audio>d</audio> <video>e</video></p></article>"
    assert html_extract.main_text(drawn, tree) == "a b cd e"
    kept = "<article><p>let <math><mi>x</mi></math> be</p><noscript><p>no script</p></noscript><object><p>instead</p></object></article>"
    assert html_extract.main_text(kept, tree) == "let x be no script instead"


def test_html_rows(spark):
    rows = [(1, "u", None, "x", 5)] + [(1, "u", "<article><p>é</p></article>", "x", 5)] * 2 + [(None, None, "", None, None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, text string, n_chars int")
    assert sorted((r["text"], r["n_chars"]) for r in html_extract.extract(df).collect()) == [("", 0), ("", 0), ("é", 1), ("é", 1)]
    assert html_extract.extract(df.limit(0)).collect() == []


def test_hmm_forward_is_exact():
    """Likelihoods and expected counts against the sum over all state paths."""
    rng = np.random.default_rng(0)
    k = hmm_lm.STATES
    emit = rng.random((5, k))
    model = hmm_lm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), emit / emit.sum(axis=0))
    seqs = [np.array(s) for s in ([0], [1, 2], [4, 4, 0], [3], [2, 2, 1])]
    want = hmm_lm.Expected(5)
    totals = []
    for s in seqs:
        paths = []
        for path in itertools.product(range(k), repeat=len(s)):
            p = model.start[path[0]] * model.emit[s[0], path[0]]
            for t in range(1, len(path)):
                p *= model.move[path[t - 1], path[t]] * model.emit[s[t], path[t]]
            paths.append((p, path))
        totals.append(sum(p for p, _ in paths))
        for p, path in paths:
            p /= totals[-1]
            want.start[path[0]] += p
            for t in range(len(path)):
                want.emit[s[t], path[t]] += p
                if t:
                    want.move[path[t - 1], path[t]] += p
    for most in (1, 4, 1 << 19):
        got = hmm_lm.Expected(5)
        seen = {}
        for batch in hmm_lm.batches_of(seqs, most):
            seen |= dict(zip(batch.own, hmm_lm.forward(model, batch)))
            got.add(model, batch)
        assert [seen[i] for i in range(len(seqs))] == pytest.approx([math.log10(x) for x in totals])
        for a, b in ((got.start, want.start), (got.move, want.move), (got.emit, want.emit)):
            assert np.allclose(a, b, atol=1e-5)


def test_hmm_counts_by_segments():
    """However short the segments, the counts are those of one segment; what is held at once does not grow with a text."""
    import tracemalloc

    rng = np.random.default_rng(5)
    seqs = [rng.integers(0, 9, n).astype("<u2") for n in (1, 40, 40, 3, 17, 1, 200)]
    model = hmm_lm.Model.first(np.full(9, 1 / 9))
    want = hmm_lm.Expected(9)
    for batch in hmm_lm.batches_of(seqs):
        want.add(model, batch)
    for most in (1, 7, 50, 150):
        got = hmm_lm.Expected(9)
        for batch in hmm_lm.batches_of(seqs, 120):
            got.add(model, batch, most)
        for a, b in ((got.start, want.start), (got.move, want.move), (got.emit, want.emit)):
            assert np.allclose(a, b, rtol=1e-4, atol=1e-5)

    def peak(n):
        batch = hmm_lm.Batch([0], [np.zeros(n, "<u2")])
        tracemalloc.start()
        hmm_lm.Expected(9).add(model, batch, 2000)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert peak(40_000) < peak(10_000) + 40_000 * 3  # borders, and no shares of all places


def test_hmm_scores(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(hmm_lm, "DICTIONARY", 3)
    monkeypatch.setattr(hmm_lm, "WORDS", 2)
    rows = docs.collect()
    held = F.col("doc_id") % 3 == 0
    told = hmm_lm.score_documents(docs, held, rounds=1).collect()
    words = lambda t: (t or "").encode().lower().split() + [None]
    train = Counter(w for r in rows if r["doc_id"] is None or r["doc_id"] % 3 for w in words(r["text"]))
    n, v = sum(train.values()), len(train)
    want = Counter((r["doc_id"], len(words(r["text"])), sum(train[w] > 0 for w in words(r["text"])), n, round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words(r["text"])), 6)) for r in rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in told) == want
    assert all(r["score"] < 0 for r in told)
    assert hmm_lm.score_documents(empty, held).collect() == []


def test_hmm_without_training(spark, docs):
    """All rows held out: no counts, and a model that is uniform over the shared symbols and the end."""
    told = hmm_lm.score_documents(docs, F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"], r["held_out"]) for r in told} == {(0, 0, True)}
    each = math.log10(hmm_lm.SUFFIXES + 1)
    assert all(r["score"] == pytest.approx(-each * r["n_tokens"]) and r["base_score"] == 0 for r in told)


def test_hmm_rounds_see_every_document(spark, monkeypatch):
    """No round on a sample of the driver's; long documents and rare ones beside copies count in each."""
    rows = [(i, "same text here") for i in range(30)] + [(i, f"w{i} " * 3100) for i in range(30, 33)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    seen = []
    whole = hmm_lm.baum_welch

    def spy(encoded, model):
        out = whole(encoded, model)
        seen.append((out[0].sum(), out[2].sum()))
        return out

    monkeypatch.setattr(hmm_lm, "baum_welch", spy)
    monkeypatch.setattr(hmm_lm.Expected, "add", None)  # of the driver's process alone
    assert len(hmm_lm.score_documents(frame, F.lit(False)).collect()) == 33
    assert len(seen) == hmm_lm.ROUNDS == 14
    assert all(a == pytest.approx(33, rel=1e-4) and b == pytest.approx(30 * 4 + 3 * 3101, rel=1e-4) for a, b in seen)


def test_langid_calibration(spark):
    """Gibberish goes by a score that held-out documents of its length set; short texts, and lengths of which little is known, stay."""
    import corpus_pipeline

    rng = random.Random(2)
    words = {"en": ["the", "and", "with", "from", "this", "that", "have"], "de": ["und", "die", "nicht", "wird", "auch", "eine", "sich"]}
    made = [(i, " ".join(rng.choices(words[lang], k=40)), lang) for i in range(1200) for lang in ("en", "de")]
    made = [(2 * i + (lang == "de"), t, lang) for i, t, lang in made]
    odd = [(90_001, "xq zkj wvv jjx qxz " * 10, None), (90_002, "the and", None), (90_003, "12 34", "en"), (90_004, None, "en"), (90_005, "xq zkj wvv " * 2000, None)]
    docs = spark.createDataFrame(made + odd, "doc_id bigint, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.stage_langid(spark, docs, "").collect()}
    lost = {i for i, *_ in made} - kept
    assert len(lost) <= 8 and 90_001 not in kept and {90_002, 90_005} <= kept and not kept & {90_003, 90_004}
    model = corpus_pipeline.train_langid(docs)
    assert set(langid.calibrate(docs.limit(0), model)) == set() and len(langid.calibrate(docs.where("lang is not null"), model)) == 1


def test_calibration_scores_all(spark):
    """More than ten thousand held-out rows of one length: the threshold is of all of them."""
    told = [(" ".join(w * 2 for w in words), lang) for lang, words in (("a", ("bede", "fogi")), ("b", ("nuso", "titu")))]
    model = langid.train(spark.createDataFrame(told, "text string, lang string"))
    rows = spark.range(11_000).select(F.concat(F.lit("bedebede fogi "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("text"), F.lit("a").alias("lang"))
    assert list(langid.calibrate(rows, model, least_known=11_000)) == [4]


def test_calibrate_scores_each_text_once(spark, monkeypatch):
    """Those told wrong have no say, and no text is predicted twice (which takes a second Python worker beside a task's first)."""
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    scored = spark.sparkContext.accumulator(0)

    def fake(model):
        @arrow_udf("struct<lang:string,score:double>")
        def predict(text: pa.Array) -> pa.Array:
            scored.add(len(text))
            words = [x.as_py().split() for x in text]
            return pa.StructArray.from_arrays([pa.array([w[0] for w in words]), pa.array([float(w[1]) for w in words])], ["lang", "score"])

        return predict

    monkeypatch.setattr(langid, "predict_udf", fake)
    right = [(f"en 0.{i:03d}", "en") for i in range(300, 700)]
    wrong = [(f"de 0.{i:03d}", "en") for i in range(100, 200)] + [("de 0.25 and more words than the others have", "en")] * 150
    rows = spark.createDataFrame([*right, *wrong, (None, "en"), ("en 0.001", None)], "text string, lang string")
    assert langid.calibrate(rows, None, lost=0.01) == {3: 0.303}
    assert scored.value == len(right) + len(wrong)
    assert langid.calibrate(rows, None, least_known=0).keys() == {3}


def test_near_dedup_stage_keeps_one_row(spark):
    """Repeated ids and rows without an id count row by row."""
    import corpus_pipeline

    rng = random.Random(5)
    a, b, c = (" ".join("".join(rng.choices("aeioubdgklmnrst", k=5)) for _ in range(40)) for _ in range(3))
    rows = [(1, a, "x"), (1, a, "x"), (1, b, "y"), (2, b, "z"), (None, a, "v"), (None, c, "w"), (None, c, "w")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = Counter((r["doc_id"], r["text"], r["lang"]) for r in corpus_pipeline.stage_near_dedup(spark, docs, "").collect())
    assert got == Counter([(1, a, "x"), (1, b, "y"), (None, c, "w")])


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choices("aeioubdgklmnrst", k=5)) for _ in range(40))
    rows = [(i, text() + "\nshared line", "en" if i % 2 else "de", "s", 1) for i in range(40)]
    rows += [(100, rows[0][1], "de", "s", 1), (101, "12 34 !!", "en", "s", 1), (102, None, None, None, None), (103, "you are an idiot idiot moron", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    named = ["__row", "__lang", "__score", "__key", "n_lines", "n_dropped", "host_pages", "line", "fp", "row_told", "KEY"]
    more = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("*", *(f"7 AS `{c}`" for c in named))
    stages = corpus_pipeline.STAGES
    for _, stage in stages[:-1]:
        out = stage(spark, more, str(tmp_path))
        assert out.columns == more.columns and {r["n_lines"] + r["row_told"] for r in out.collect()} <= {14} and out.count() > 30
        assert stage(spark, more.limit(0), str(tmp_path)).collect() == []
    assert stages[-1][1](spark, more.limit(0), str(tmp_path)).collect() == []
    unlabelled = more.withColumn("lang", F.lit(None).cast("string"))  # nothing to learn a language from: what has a letter stays
    assert corpus_pipeline.stage_langid(spark, unlabelled, str(tmp_path)).count() == 42
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(range(40))


def test_hmm_gathers_whole_sequences():
    groups = [[np.zeros(n, "<u2") for n in sizes] for sizes in ([5, 1], [], [2, 2], [9], [1])]
    got = list(hmm_lm._gathered(groups, 8))
    assert [[len(x) for x in g] for g in got] == [[5, 1, 2, 2], [9], [1]]
    assert list(hmm_lm._gathered([], 8)) == []


def test_hmm_counts_do_not_depend_on_gathering(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(bytes(rng.integers(0, 9, int(n)).astype("<u2").tobytes()),) for n in (1, 4, 300, 2, 7, 7)]
    model = hmm_lm.Model.first(np.full(9, 1 / 9))
    frame = spark.createDataFrame(rows, "symbols binary")
    want = hmm_lm.baum_welch(frame.repartition(4), model)
    monkeypatch.setattr(hmm_lm, "_HELD", 3)
    for a, b in zip(want, hmm_lm.baum_welch(frame.coalesce(1), model)):
        np.testing.assert_allclose(a, b, rtol=1e-4, atol=1e-6)
