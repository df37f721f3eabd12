"""Each operator against a brute-force version, on a table that also holds nulls, empty, long and repeated rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidecart.llm import (
    class_lm,
    common,
    decontamination,
    embedding_dedup,
    graph,
    jaccard_join,
    kneser_ney,
    language_id,
    packing,
    pii,
    substring_dedup,
    toxicity,
)


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def same(found, expected):
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def root_of(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_packing(documents, texts):
    from tokenizers import Tokenizer
    import public_tokenizers

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for doc, text in texts:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    rows = packing.pack_documents(documents).collect()
    assert Counter(tuple(r)[:5] for r in rows) == expected
    end = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == end[r["sequence_id"]]
        end[r["sequence_id"]] += r["length"]
    assert max(end.values()) <= 1024
    assert len(end) <= 1.02 * sum(end.values()) / 1024 + 2


def test_packing_white_space_cuts():
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mine = packing._Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in ["a  b", " a", "a ", " ", "  ", "a \n b", "a\n b", "a 　 b", "x <|endoftext|> y", "it's 12 34!", "\t a\t", "a  b c "]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == coder.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("counts", [{}, {1024: 3}, {600: 5, 424: 5}, {10: 1000}, {700: 3, 300: 4, 20: 9, 1: 5}])
def test_sweep_fills_sequences(counts):
    plan, opened = packing.sweep_plan(counts, 1024)
    assert sum(s * n for s, n in counts.items()) <= opened * 1024
    assert opened <= 1.2 * sum(s * n for s, n in counts.items()) / 1024 + max(1, sum(n for s, n in counts.items() if s > 512))
    assert len({(s, rank) for s, rank, *_ in plan}) == len(plan)


def test_substring_dedup(documents, texts):
    low = {}
    for doc, text in texts:
        words = (text or "").encode().split()
        for k in range(len(words) - 49):
            if doc is not None:
                low[tuple(words[k : k + 50])] = min(doc, low.get(tuple(words[k : k + 50]), doc))
    expected = []
    for doc, text in texts:
        words, gone = (text or "").encode().split(), set()
        for k in range(len(words) - 49):
            if doc is not None and low[tuple(words[k : k + 50])] < doc:
                gone.update(range(k, k + 50))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        expected.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    assert sum(e[2] for e in expected) > 0
    same(substring_dedup.report(documents).collect(), expected)


def test_class_lm(documents, texts):
    cut = lambda t: [*(t or "").encode().lower().split(), b""]
    fold = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    count = Counter()
    for doc, text in texts:
        if not fold(doc):
            count.update(cut(text))
    total, distinct = sum(count.values()), len(count)
    rows = class_lm.report(documents).collect()
    expected = Counter()
    for doc, text in texts:
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in cut(text))
        expected[doc, fold(doc), len(cut(text)), sum(count[w] > 0 for w in cut(text)), total, round(base, 5)] += 1
    assert Counter((*tuple(r)[:5], round(r["base_score"], 5)) for r in rows) == expected
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_class_lm_rare_words_take_the_join(documents, monkeypatch):
    whole = {(r["doc_id"], r["doc_key"]): r for r in class_lm.score(documents, class_lm.train(documents)).collect()}
    monkeypatch.setattr(class_lm, "HEAD_WORDS", 700)
    for r in class_lm.score(documents, class_lm.train(documents)).collect():
        other = whole[r["doc_id"], r["doc_key"]]
        assert r["n_known"] == other["n_known"]
        assert r["base_score"] == pytest.approx(other["base_score"]) and r["score"] == pytest.approx(other["score"])


def test_class_lm_knows_the_end_token_beside_more_frequent_words(spark, monkeypatch):
    words = [f"w{k}" for k in range(710)]
    docs = spark.createDataFrame([(1, " ".join(words * 3)), (2, " ".join(words[::-1] + words))], "doc_id long, text string")
    whole = {r["doc_id"]: r["score"] for r in class_lm.score(docs, class_lm.train(docs)).collect()}
    monkeypatch.setattr(class_lm, "HEAD_WORDS", 700)
    model = class_lm.train(docs)
    assert len(model.head) == 700 and class_lm.END in dict(model.head)
    for r in class_lm.score(docs, model).collect():
        assert r["score"] == pytest.approx(whole[r["doc_id"]])


def test_class_lm_head_is_cut_before_it_is_sorted(spark):
    rows = [(b"", 3), *[(b"w%03d" % k, 9 if k < 40 else 5 if k < 140 else 1) for k in range(400)]]
    counts = spark.createDataFrame(rows, "word binary, n long").repartition(8)
    for limit in (1, 41, 60, 141, 142, 401, 500):
        assert class_lm.frequent_words(counts, limit) == rows[:limit]
    assert class_lm.frequent_words(counts.limit(0), 5) == []


def test_class_lm_sends_the_driver_no_rows_one_by_one(documents, monkeypatch):
    sent, collect = [], type(documents).collect
    monkeypatch.setattr(type(documents), "collect", lambda frame: sent.append(collect(frame)) or sent[-1])
    model = class_lm.train(documents)
    assert len(model.head) > 700 and max(map(len, sent)) <= class_lm.GROUPS  # the head and the bigrams of units come as Arrow


def test_class_lm_classes_rare_words_by_their_neighbours(spark, monkeypatch):
    """Words beyond the units that end alike, but stand where different units do, take the classes of these."""
    words = [f"{c}{k:03d}" for c in "xy" for k in range(40)]
    texts = [" ".join(["a p b"] * 20 + ["u9 q v99"] * 20 + ["a", words[k], "b"] * 3 + ["u9", words[k + 40], "v99"] * 3) for k in range(40)]
    texts += [" ".join(f"u{k} v{k}" for k in range(318))] * 20  # 640 units, all more frequent
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = []
    for head in (class_lm.HEAD_WORDS, 650):
        monkeypatch.setattr(class_lm, "HEAD_WORDS", head)
        model = class_lm.train(docs)
        rows = {r["key"]: r for r in model.classes.collect()}
        found = [rows[int(k)] for k in class_lm._hashes([w.encode() for w in words]).view(np.int64)]
        of = dict(zip([w for w, _ in model.head], model.local.tolist()))
        assert len(rows) == 80 and {r["n"] for r in found} == {3} and of[b"p"] != of[b"q"]
        assert {r["c"] for r in found[:40]} == {of[b"p"]} and {r["c"] for r in found[40:]} == {of[b"q"]}
        asked = spark.createDataFrame([(1, "a x003 b"), (2, "a y003 b"), (3, "new")], docs.schema)
        scores.append({r["doc_id"]: r["score"] for r in class_lm.score(asked, model).collect()})
        assert scores[-1][1] > scores[-1][2] + 0.5
    assert scores[0] == pytest.approx(scores[1])


def test_exchange_separates_alternating_units():
    pairs = np.zeros((4, 4))
    pairs[0, 1] = pairs[1, 0] = pairs[2, 3] = pairs[3, 2] = 50
    of = class_lm.exchange(pairs, classes=4)
    assert len({of[0], of[1]}) == 2 or len({of[2], of[3]}) == 2


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 16))
    x[200:300] = x[:100] + rng.normal(scale=0.04, size=(100, 16))
    x[300:350] = x[0]
    rows = [(k, [float(np.float32(v)) for v in row]) for k, row in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16), (1004, []), (1005, [1.0, 2.0]), (1006, [2.0, 4.0]), (None, [3.0, 6.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = [(k, np.array(v)) for k, v in rows[:400]] + [(k, np.array(v)) for k, v in rows[-3:]]
    unit = [v / np.linalg.norm(v) for _, v in good]
    parent, links = list(range(len(good))), Counter()
    for a in range(len(good)):
        for b in range(a):
            if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95:
                links[a] += 1
                links[b] += 1
                parent[max(root_of(parent, a), root_of(parent, b))] = min(root_of(parent, a), root_of(parent, b))
    expected = []
    for a, (vec, _) in enumerate(good):
        group = [good[b][0] for b in range(len(good)) if root_of(parent, b) == root_of(parent, a)]
        least = min((g for g in group if g is not None), default=None)
        expected.append((vec, links[a], least, vec == least if vec is not None else True))
    expected += [(k, 0, k, True) for k in range(1000, 1005)]
    found = [tuple(r)[:4] for r in embedding_dedup.report(frame).collect()]
    assert sum(r[1] for r in found) >= 0.9 * sum(r[1] for r in expected)
    same(found, expected)


def test_traversal_visits_nearest_cells_first():
    rng = np.random.default_rng(1)
    a, b = rng.random((5, 7)), rng.random((5, 6))
    for row, (cells, sums) in enumerate(zip(*embedding_dedup.traversal(a, b, 9))):
        every = (a[row][:, None] + b[row][None]).reshape(-1)
        assert every[cells].tolist() == sums.tolist() == np.sort(every)[:9].tolist()
    cells, sums = embedding_dedup.traversal(np.ones((1, 3)), np.ones((1, 4)), 5)
    assert cells[0].tolist() == [0, 1, 2, 3, 4] and set(sums[0]) == {2.0}


@pytest.mark.parametrize("n, pairs", [(6000, 4), (4000, 200)])
def test_rare_near_copies_are_found_from_both_ends(spark, n, pairs):
    """Random vectors, and pairs just above the threshold: as many links as brute force, each seen from both of its ends."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u = rng.normal(size=(pairs, 32))
    u -= (u * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    x[n - pairs :] = 0.955 * x[:pairs] + np.sqrt(1 - 0.955**2) * u
    near = x @ x.T >= 0.95
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in embedding_dedup.report(frame).collect()}
    links = np.array([found[k]["n_links"] for k in range(n)])
    assert (links <= near.sum(1) - 1).all() and links.sum() >= 0.99 * (near.sum() - n)
    for k in range(n):
        assert (found[k]["component_id"] != k or not found[k]["kept"]) or links[k] == 0 or min(np.flatnonzero(near[k])) == k
        assert links[k] or found[k]["component_id"] == k
    group = Counter(found[k]["component_id"] for k in range(n) if links[k])
    assert all(size >= 2 for size in group.values())


def test_kneser_ney(documents, tables):
    labels = tables("labels")
    rows = kneser_ney.judge(documents, labels.where("quality = 1")).collect()
    assert len(rows) == documents.count()
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    wrong = [r["doc_id"] for r in rows if quality.get(r["doc_id"]) == 1 and r["rejected"]]
    caught = [r["rejected"] for r in rows if quality.get(r["doc_id"]) == 0]
    assert not wrong and np.mean(caught) > 0.8
    nobody = kneser_ney.judge(documents, labels.where("false"))
    assert nobody.where("rejected").count() == 0


def test_kneser_ney_learns_from_all_trusted_documents(spark, monkeypatch):
    docs = spark.range(16_300).selectExpr("id as doc_id", "concat('w', id % 7, ' v', id % 5) as text", "'en' as lang")
    learned, train = [], kneser_ney.train
    monkeypatch.setattr(kneser_ney, "train", lambda texts: learned.append(texts.count()) or train(texts))
    assert kneser_ney.judge(docs, docs.where("doc_id >= 100").select("doc_id")).count() == 16_300
    assert learned == [16_200]


def test_kneser_ney_sums_to_one_and_joins_like_lookups(documents, spark, monkeypatch):
    trusted = documents.where("doc_id < 60").select("text")
    model = kneser_ney.train(trusted, vocabulary_size=50)
    keys, gains = model.frequent
    gain = dict(zip(keys.tolist(), gains.tolist()))
    alone = model.alone.copy()
    alone[kneser_ney.OTHER] += np.log10(kneser_ney.OTHER_FORMS)
    for a in (0, 1, 5):
        total = sum(10 ** (model.back[a] + alone[b] + gain.get((a << 20) | b, 0.0)) for b in range(len(alone)))
        assert total == pytest.approx(1.0, abs=1e-6)
    whole = {(r["doc_id"], r["doc_key"]): r["log_prob"] for r in kneser_ney.score(documents, model).collect()}
    monkeypatch.setattr(kneser_ney, "FREQUENT", 100)
    few = kneser_ney.train(trusted, vocabulary_size=50)
    for r in kneser_ney.score(documents, few).collect():
        assert r["log_prob"] == pytest.approx(whole[r["doc_id"], r["doc_key"]])


def _kneser_ney(learned, own=None):
    """log10 P(text) by dictionaries: a bigram model of whole texts, and of one text's bigrams as if ``own`` were not counted."""
    edge = b""
    cut = lambda t: [edge, *(t or "").encode().split(), edge]
    n = Counter(p for t in learned for p in zip(cut(t)[:-1], cut(t)[1:]))
    c, total, kinds = Counter(b for _, b in n), Counter(), Counter()
    d, e = (kneser_ney._discounts([list(v.values()).count(k) for k in (1, 2, 3, 4)]) for v in (n, c))
    left = Counter()
    for (a, _), k in n.items():
        total[a] += k
        left[a] += d[min(k, 3) - 1]
    mass = sum(e[min(k, 3) - 1] for k in c.values()) / sum(c.values())

    def log_prob(text, own):
        mine, result = Counter(zip(cut(text)[:-1], cut(text)[1:])), 0
        for (a, b), times in mine.items():
            p = mass / (len(c) + kneser_ney.OTHER_FORMS) + ((c[b] - e[min(c[b], 3) - 1]) / sum(c.values()) if c[b] else 0)
            k = n[a, b] - own * times
            if total[a]:
                p = ((k - d[min(k, 3) - 1] if k > 0 else 0) + left[a] * p) / total[a]
            result += times * np.log10(p)
        return result

    return log_prob


def test_kneser_ney_counts_all_words(documents, monkeypatch):
    trusted = documents.where("doc_id < 40 or doc_id > 899").select("text")
    expected = _kneser_ney([r["text"] for r in trusted.collect()])
    some = documents.where("doc_id < 60 or doc_id > 899 or doc_id is null")
    keyed = {row_key: text for row_key, text in some.selectExpr("xxhash64(doc_id, text)", "text").collect()}
    for limit, size in ((kneser_ney.FREQUENT, kneser_ney.ROUND_BYTES), (50, 30_000)):
        for name, value in (("LOCAL_WORDS", limit), ("FREQUENT", limit), ("ROUND_BYTES", size), ("ASKED", limit)):
            monkeypatch.setattr(kneser_ney, name, value)
        model = kneser_ney.train(trusted)
        assert len(model.words) <= limit and len(model.frequent[0]) <= limit and (len(model.tables) > 1) == (limit == 50)
        rows = kneser_ney.score(some, model).collect()
        assert len(rows) == some.count()
        for r in rows:
            text = keyed[r["doc_key"]]
            assert r["n_tokens"] == len((text or "").encode().split()) + 1
            for name, own in (("log_prob", 0), ("own", 1)):
                assert r[name] == pytest.approx(expected(text, own), rel=1e-6, abs=1e-3)  # single precision, six thousand times


def test_kneser_ney_knows_what_follows_rare_words(spark):
    words = [f"w{k}" for k in range(6_000)]
    docs = spark.createDataFrame([(k, " ".join(words), "en") for k in range(3)], "doc_id long, text string, lang string")
    model = kneser_ney.train(docs.select("text"))
    asked = spark.createDataFrame([(1, " ".join(words[5_800:]), "en"), (2, " ".join(words[:5_799:-1]), "en")], docs.schema)
    found = {r["doc_id"]: r["log_prob"] for r in kneser_ney.score(asked, model).collect()}
    assert found[1] > found[2] / 2  # each word follows the one before; backwards none does


def test_toxicity_gradients():
    rng = np.random.default_rng(5)
    p = {"a": rng.normal(size=16), "o": rng.normal(size=16), "c": np.zeros(1)}
    for side in "fb":
        p |= {f"w{side}": rng.normal(size=(toxicity.INPUT, 24)) * 0.3, f"u{side}": rng.normal(size=(8, 24)) * 0.3, f"b{side}": rng.normal(size=24)}
    x, mask, y = rng.normal(size=(5, 3, toxicity.INPUT)), np.ones((5, 3), bool), np.array([1.0, 0.0, 1.0])
    mask[3:, 1] = False
    _, g, dx = toxicity.gradients(p, x, mask, y)
    for name in p:
        at = (0,) * p[name].ndim
        keep, ends = p[name][at], []
        for step in (1e-5, -1e-5):
            p[name][at] = keep + step
            ends.append(toxicity.gradients(p, x, mask, y)[0])
        p[name][at] = keep
        assert g[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-3, abs=1e-6)
    x[0, 0, 0] += 1e-5
    up = toxicity.gradients(p, x, mask, y)[0]
    x[0, 0, 0] -= 2e-5
    assert dx[0, 0, 0] == pytest.approx((up - toxicity.gradients(p, x, mask, y)[0]) / 2e-5, rel=1e-3, abs=1e-6)


def test_toxicity(spark, documents):
    rng = np.random.default_rng(2)
    plain = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(240):
        line = list(rng.choice(plain, 120))
        if k % 2:
            line[rng.integers(120)] = "idiot"
            line[rng.integers(120)] = "scum"
        rows.append((k, " ".join(line), k % 2))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = {r["doc_id"]: r for r in toxicity.report(frame, frame.select("doc_id", "toxic")).collect()}
    held = [(r["predicted"], k % 2) for k, r in found.items() if r["held_out"]]
    assert len(found) == 240 and np.mean([a == b for a, b in held]) > 0.95
    odd = toxicity.report(documents, frame.select("doc_id", "toxic")).collect()
    assert len(odd) == documents.count() and all(0 <= r["score"] <= 1 for r in odd)
    none = toxicity.report(documents, frame.where("false").select("doc_id", "toxic"))
    assert none.where("score <> 0").count() == 0


def _words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


def test_decontamination(spark, documents, texts, tables):
    items = [(r["item_id"], r["text"]) for r in tables("benchmark").collect()]
    items += [(70001, None), (70002, "..."), (70003, "in a row"), (70003, "in a row"), (70004, "same words in a row same words in a row same words")]
    items.append((None, "W w W w W w w w w w w w"))
    frame = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for item, text in items:
        words = _words(text)
        for k in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[k : k + 10])].add("" if item is None else str(item))
    expected = []
    for doc, text in texts:
        words, hit, named = _words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if found := windows.get(tuple(words[k : k + n])):
                    hit.update(range(k, k + n))
                    named |= found
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        expected.append((doc, len(words), len(hit), len(named), digest, bool(hit)))
    assert any(e[-1] for e in expected)
    same(decontamination.report(documents, frame).collect(), expected)
    assert decontamination.report(documents, frame.where("false")).where("contaminated").count() == 0


def test_decontamination_compares_words_in_small_methods(spark, documents, tables, capsys):
    """The JVM leaves methods of more than 8000 bytes of code interpreted; words compared one by one in the code made one of 19,777."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        decontamination.phrase_matches(documents, tables("benchmark")).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_small_batches_hold_and_end(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    with pytest.raises(ZeroDivisionError), common.small_batches(spark):
        rows = common.stored(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long")).collect()
        assert max(r["n"] for r in rows) <= common.BATCH_ROWS and sum(r["n"] for r in rows) == 5000
        1 / 0
    assert spark.conf.get(name) == before


def test_proximity(spark):
    frame = spark.createDataFrame([(1, "alpha b c beta"), (2, "alpha b c d e beta"), (3, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in decontamination.proximity_matches(frame, "beta alpha", 4).collect()] == [1]
    assert decontamination.proximity_matches(frame, "nowhere", 4).count() == 0


def _jaccard(texts):
    sets = []
    for _, text in texts:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    parent, cells = list(range(len(sets))), defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            cells[g].append(k)
    common = Counter((a, b) for group in cells.values() for k, b in enumerate(group) for a in group[:k])
    for (a, b), c in common.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            x, y = root_of(parent, a), root_of(parent, b)
            parent[max(x, y)] = min(x, y)
    out = []
    for k, (doc, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if root_of(parent, j) == root_of(parent, k)]
        out.append((doc, len(sets[k]), min((i for i in ids if i is not None), default=None)))
    return out


def test_jaccard_join(documents, texts):
    same(jaccard_join.report(documents).collect(), _jaccard(texts))


def test_jaccard_join_of_crowded_regions(spark, monkeypatch):
    """Many near copies around a base, chains, and a passage everybody quotes; small blocks and an early common list."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "COMMON", 6)
    rng = np.random.default_rng(4)
    base, passage = [f"b{k}" for k in range(100)], [f"p{k}" for k in range(12)]
    texts = []
    for k in range(40):
        line = list(base)
        for at in rng.choice(100, rng.integers(0, 6), replace=False):
            line[at] = f"x{rng.integers(10**6)}"
        texts.append((len(texts), " ".join(line)))
    for k in range(30):
        texts.append((len(texts), " ".join([*passage, *(f"u{k}_{i}" for i in range(rng.integers(1, 40)))])))
    step = [f"s{k}" for k in range(60)]
    for k in range(10):
        texts.append((len(texts), " ".join([*step[k * 2 :], *(f"t{i}" for i in range(k * 2))])))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    same(jaccard_join.report(frame).collect(), _jaccard(texts))


def test_jaccard_points_leave_cells_without_a_possible_partner(spark):
    """Texts of very different sizes that all quote a passage meet nobody; two of one size stay in cells."""
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [passage + "".join(f" u{k}_{i}" for i in range(50 << k)) for k in range(6)]
    none = np.empty(0, np.uint64)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert jaccard_join.cells(frame, none).count() == 0
    texts.append(texts[2] + " more")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert jaccard_join.cells(frame, none).select("node").distinct().count() == 2
    same(jaccard_join.report(frame).collect(), _jaccard(list(enumerate(texts))))


def test_jaccard_cells_in_small_batches(spark):
    """Near copies of many sizes around the threshold, some of them twice, with cells that go over several batches."""
    rng = np.random.default_rng(14)
    words = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(90):
        line = words[rng.integers(0, 15) : 120 - rng.integers(0, 25)]
        line = [f"x{rng.integers(10**6)}" if rng.random() < 0.01 else w for w in line]
        texts += [" ".join(line)] * (1 + k % 2)
    rows = list(enumerate(texts))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        same(jaccard_join.report(spark.createDataFrame(rows, "doc_id long, text string")).collect(), _jaccard(rows))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_jaccard_sketches_tell_large_sets_apart():
    rng = np.random.default_rng(11)
    draw = lambda n: np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
    for n in (300, 3000, 6000, 60000):
        x, y = jaccard_join._sketch(draw(n)), jaccard_join._sketch(draw(n))
        assert jaccard_join._apart(x[None], y[None])[0] * 180 > 2 * n * 20


def test_jaccard_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(12)
    base = rng.integers(0, 1 << 64, 5000, dtype=np.uint64)
    narrow = rng.integers(0, 1 << 56, 3000, dtype=np.uint64)  # all in one bucket of the coarsest histogram
    sets = [np.unique(base[:k]) for k in (90, 1000, 1030, 2100, 4090, 4100, 5000)] + [np.unique(narrow[:k]) for k in (200, 700, 2000, 3000)]
    sketches = jaccard_join._Sketches(pa.array([jaccard_join._sketch(s).tobytes() for s in sets], pa.binary()))
    true = np.array([[len(np.setxor1d(a, b)) for b in sets] for a in sets])
    every = np.arange(len(sets))
    for x in every:
        assert (sketches.apart_from(x, every) <= true[x]).all()
        turned = jaccard_join._Sketches(pa.array([jaccard_join._sketch(sets[(k + x) % len(sets)]).tobytes() for k in every], pa.binary()))
        found = jaccard_join._apart_by_row(sketches, turned)
        assert found.tolist() == [sketches.apart_from(k, np.array([(k + x) % len(sets)]))[0] for k in every]


def test_jaccard_large_unrelated_texts_make_no_pairs(spark, monkeypatch):
    """Texts of 6000 words that share a passage and are long otherwise: one region, no candidates; and one near copy that is found."""
    rng = np.random.default_rng(13)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = [f"{passage} " + " ".join(map(str, rng.integers(0, 10**9, 6000 + 20 * k))) for k in range(20)]
    texts.append(texts[5].rsplit(" ", 200)[0])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made, verified = [], jaccard_join._verified_in_rounds
    monkeypatch.setattr(jaccard_join, "_verified_in_rounds", lambda pairs, *rest: made.append(pairs.count()) or verified(pairs, *rest))
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.report(docs).collect()}
    assert found == {k: 5 if k == 20 else k for k in range(21)} and made == [0]


def test_jaccard_shared_shingles(documents, texts):
    _, shared = jaccard_join.points(documents.coalesce(1))
    sets = {tuple(s.tolist()) for s in jaccard_join.shingle_sets(pa.array([(t or "").encode() for _, t in texts], pa.binary()))}
    times = Counter(h for s in sets for h in s)
    assert {r["h"] % 2**64: r["times"] for r in shared.collect()} == {h: n for h, n in times.items() if n > 1}


def test_components(spark):
    path = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    found = graph.components(spark.createDataFrame(path, "a long, b long")).collect()
    same(found, [(k, 0) for k in range(41)] + [(k, 90) for k in (90, 95, 100)])
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language(spark, documents):
    found = {r["doc_id"]: r for r in language_id.report(spark, documents).collect()}
    assert found[900]["lang_pred"] == found[901]["lang_pred"] == "und" and found[900]["score"] == 0
    true = {r["doc_id"]: r["lang"] for r in documents.where("doc_id < 900").collect()}
    held = [found[d]["lang_pred"] == lang for d, lang in true.items() if found[d]["held_out"]]
    assert np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())
    nothing = language_id.classify(documents, language_id.learn(documents.where("false")))
    assert nothing.where("lang_pred <> 'und'").count() == 0


def test_language_equals_compressing_with_each_dictionary(spark, documents):
    """Brute force: every text against every dictionary, block by block, smallest wins."""
    import zstandard

    fold = [(r["doc_id"], r["text"], r["lang"]) for r in documents.collect()]
    known = language_id.learn(documents.where(language_id.crc("doc_id") % 4 != 2))
    counts = Counter(lang for d, t, lang in fold if lang and t and zlib.crc32(str("" if d is None else d).encode()) % 4 != 2)
    assert list(known) == sorted(counts, key=lambda x: (-counts[x], x))
    assert all(8 <= len(v) <= language_id.DICTIONARY_BYTES for v in known.values())
    found = {(r["doc_id"], r["lang_pred"]) for r in language_id.report(spark, documents).collect()}
    for d, text, _ in fold[:150] + fold[-9:]:
        best, least = "und", None
        if any(c.isalpha() for c in text or ""):
            plain = language_id._plain(text)
            for lang, content in known.items():
                raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                coder = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
                size = sum(len(coder.compress(plain[k : k + language_id.BLOCK_BYTES])) for k in range(0, len(plain), language_id.BLOCK_BYTES))
                if least is None or size < least:
                    best, least = lang, size
        assert (d, best) in found


def test_language_of_each_kind_of_text_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = language_id.report(spark, docs).where("held_out").join(docs, "doc_id").where("lang is not null and lang_pred <> 'und'")
    per = found.groupBy("lang").agg((F.sum((F.col("lang") == F.col("lang_pred")).cast("int")) / F.count(F.lit(1))).alias("share")).collect()
    assert len(per) == 4 and all(r["share"] >= 0.98 for r in per)


def test_marks_that_are_no_letters_have_no_language(spark):
    odd = spark.createDataFrame([(1, "½ ² 3 ٣"), (2, "Ⅷ"), (3, "é"), (4, "__"), (5, "中")], "doc_id long, text string")
    known = {"en": b"the and of in to it is that", "fr": b"le la les et un une \xc3\xa9t\xc3\xa9"}
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.classify(odd, known).collect()}
    assert {d for d, lang in found.items() if lang == "und"} == {1, 2, 4}


_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def _plain(text):
    def fine(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(_KINDS) for m in re.finditer(p, text) if fine(kind, m.group())]
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def test_pii(documents, texts):
    expected = []
    for doc, text in texts:
        spans = _plain(text or "")
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == k for s in spans) for k, _ in _KINDS]
        expected.append((doc, *counts, hashlib.sha256(written.encode()).hexdigest()))
    found = pii.report(documents).collect()
    same([tuple(r)[:6] for r in found], expected)
    assert all(r["spans"] is not None for r in found)


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e", "x.y@z", "@a.b", "a@@b.c", "1.2.3.4.5.6.7.8", "999.1.1.1", "1.2.3.400 01.02.03.04", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (414) 555-7134.", "+12 3", "++49 151 23456789-", "1234567890128 4111111111111111", "a" * 500 + "@" + "b" * 50, "é@b.de ü", "1" * 4000],
)
def test_plain_spans(text):
    assert pii.plain_spans(text) == _plain(text)


@pytest.mark.parametrize(
    "text, kind, part",
    [
        ("write jo (at) mail (dot) example (dot) com now", "email", "jo (at) mail (dot) example (dot) com"),
        ("write jo at example dot com now", "email", "jo at example dot com"),
        ("write jo@mail[.]example.com now", "email", "jo@mail[.]example.com"),
        ("write jо@еxample.com now", "email", "jо@еxample.com"),
        ("from １２.71.76.174 on", "ip", "１２.71.76.174"),
        ("call plus one four one four five five five seven one three four now", "phone", "plus one four one four five five five seven one three four"),
        ("host one nine two dot one six eight dot one dot seven yes", "ip", "one nine two dot one six eight dot one dot seven"),
        ("mail a​b@c.de", "email", "a​b@c.de"),
    ],
)
def test_disguised_spans(text, kind, part):
    base, found = pii.spans(text)
    start = text.index(part)
    assert (kind, start, start + len(part)) in found
    assert set(base) <= set(found)


def test_prose_is_left_alone():
    for text in ["look at the dot on the map", "one two three go", "he was at home. Dot came", "meet at noon.Then go", "un deux trois"]:
        assert pii.spans(text) == ([], [])


def test_masked():
    text = "a@b.de and 12.71.76.174!"
    assert pii.masked(text, pii.spans(text)[1]) == "<email> and <ip>!"


def test_empty_tables(spark, documents, tables):
    none = documents.where("false")
    labels = tables("labels")
    for frame in [
        packing.pack_documents(none), substring_dedup.report(none), class_lm.report(none), kneser_ney.report(none, labels),
        toxicity.report(none, labels), decontamination.report(none, tables("benchmark")), jaccard_join.report(none),
        language_id.report(spark, none), pii.report(none), embedding_dedup.report(tables("embeddings").where("false")),
    ]:
        assert frame.count() == 0


def test_personal_data_of_odd_and_long_texts_is_found_in_linear_time():
    import time

    assert pii.spans("0" * 5000 + ".1.1.1")[0] == [("ip", 0, 5006)]
    assert pii.spans("9" * 5000 + ".1.1.1")[0] == []
    texts = ["one two " + "dot " * 20_000, "a [dot] " * 20_000, "a at b " * 20_000, "a dot " * 20_000 + "x at y dot com", "one " * 20_000,
             "a@b.cc " * 20_000 + "\u0430@b.cc", "at " * 20_000, "@ " * 20_000, "(at)" * 20_000, "1 " * 20_000, "+1 " * 20_000]
    for text in texts:
        began = time.process_time()
        pii.spans(text)
        assert time.process_time() - began < 2, text[:20]


def test_disguises():
    found = lambda text: pii.spans(text)[1]
    assert found("write to bob [at] example (dot) org now") == [("email", 9, 35)]
    assert found("mail ann dot lee at mail dot example dot com please") == [("email", 5, 44)]
    assert found("x at @joe.example.org y")[0][0] == "email"
    assert found("call plus one four one four five five five seven one three four ok") == [("phone", 5, 63)]
    assert found("look at the dot and five six") == [] and found("5 6 7 8") == []


def test_large_batches_are_handled_in_pieces(spark):
    """Personal data is looked for in slices of a batch, not in ten thousand texts at once."""
    texts = [None, "", "x" * 700, "mail a.b@c.org now", "y" * 5000, "é" * 300, None, "4111 1111 1111 1111", "z" * 400, "end"]
    batch = pa.record_batch([pa.array(range(10)), pa.array(texts, pa.string())], names=["doc_id", "text"])
    parts = list(common.pieces(batch.slice(1), 1, 1000))
    assert pa.Table.from_batches(parts).to_pylist() == batch.slice(1).to_pylist()
    sizes = [sum(len((t or "").encode()) for t in part.column(1).to_pylist()) for part in parts]
    assert len(parts) > 3 and all(n <= 1000 or part.num_rows == 1 for n, part in zip(sizes, parts))
    assert list(common.pieces(batch.slice(0, 0), 1)) == []
    many = [(k, t and t * (200 if len(t) > 250 else 1)) for k, t in enumerate(texts)] * 3
    found = pii.find_pii(spark.createDataFrame(many, "doc_id long, text string").coalesce(1), mask=True).collect()
    assert sorted((r["doc_id"], r["clean"]) for r in found) == sorted((k, pii.masked(t or "", pii.spans(t or "")[1])) for k, t in many)
