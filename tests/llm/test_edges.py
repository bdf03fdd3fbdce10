"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordlake.session import work_path
from recordlake.llm import boilerplate, components, dac, hmm, jaccard, langid, leaks, mixing, quality, suffixes, text, tokencounts, tokens

BPE = tokens.tokenizer_path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, frag int, size string"


def words(t):
    return (t or "").encode().lower().split()


def make(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    full = [(i, t, lang, source, len(t or ""), 0.5, 7, "x") for i, t, lang, source in rows]
    return spark.createDataFrame(full, DOCS)


def corpus(seed=3, n=120):
    rng = random.Random(seed)
    vocab = {"en": "the of and to in that with river stone light under over".split(),
             "fr": "le la des une pour être où très château forêt déjà".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        t = " ".join(rng.choice(vocab[lang]) + rng.choice(["", "", ",", ".\n"]) for _ in range(rng.randint(1, 120)))
        if rows and rng.random() < 0.3:
            _, t, lang, _ = rng.choice(rows)
            if rng.random() < 0.6 and t:
                w = t.split(" ")
                w[rng.randrange(len(w))] = "changed"
                t = " ".join(w)
        rows.append((i, t, lang, f"s{rng.randint(0, 3)}"))
    rows += [(n, None, "en", None), (n + 1, "", "fr", "s0"), (n + 2, " \t\n ", None, None), (n + 3, "12 !! 34", "en", "s1"),
             (n + 4, "the river " * 6000, "en", "hot"), (None, "the of and to in", "en", None), (n + 5, "solo", "en", "s1")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return make(spark, rows).cache()


@pytest.fixture(scope="module")
def none(spark):
    return make(spark, []).cache()


# ---- helpers ------------------------------------------------------------------------------------


def test_words_and_shingles():
    texts = text.plain(pa.array([" A b\x0bC ", None, "", "x", "é É z"]))
    flat, at = text.words(texts)
    assert flat.to_pylist() == ["a", "b", "c", "x", "é", "É", "z"] and at.tolist() == [0, 3, 3, 3, 4, 7]
    h, ends = text.shingles(text.word_hashes(flat), at, 3)
    assert ends.tolist() == [0, 1, 1, 1, 2, 3] and len(set(h.tolist())) == 3


def test_hash_is_of_content_only():
    values = ["", "a", "b", "abcdefgh", "abcdefghi", "x" * 100, "x" * 101]
    one = text.hash_strings(text.plain(pa.array(values)))
    two = text.hash_strings(text.plain(pa.array(["pad", *values])))[1:]
    assert (one == two).all() and len(set(one.tolist())) == len(values)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)], "a long, b long")
    got = {r["node"]: r["comp"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


# ---- 1 ------------------------------------------------------------------------------------------


def cut_by_hand(rows, length):
    seen, out = set(), {}
    for d, t in sorted({(d, t) for d, t in rows if d is not None}, key=lambda r: r[0]):
        body = (t or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            w = body[i:i + length]
            if w in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(w)
        rest = bytes(c for c, g in zip(body, gone) if not g)
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(body)))
        out[d] = (len(body), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


@pytest.mark.parametrize("hot", [4096, 2])
@pytest.mark.parametrize("length", [20, 100])
def test_suffixes(spark, docs, rows, length, hot):
    want = cut_by_hand([(r[0], r[1]) for r in rows], length)
    twice = docs.unionByName(docs.where("doc_id < 5"))
    got = suffixes.drop_repeats(twice, length, hot=hot)
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    for r in got.drop("kept").collect():
        if r["doc_id"] is None:  # no place in the order: returned whole
            assert r["n_removed"] == 0
        else:
            assert tuple(r)[1:] == want[r["doc_id"]]
            assert hashlib.sha256(kept[r["doc_id"]]).hexdigest() == r["kept_sha256"]
    assert got.count() == len(rows) + 5


def test_suffixes_empty(none):
    assert suffixes.drop_repeats(none).count() == 0


def test_loser_tree():
    rng = random.Random(5)
    for k in (1, 2, 3, 7):
        pieces = [sorted((bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))), (i, j, 0, 1, 0)) for j in range(rng.randint(0, 9))) for i in range(k)]
        merged = list(suffixes.LoserTree([suffixes.unfold(suffixes.front_code(p)) for p in pieces]))
        assert [s for _, s, _ in merged] == sorted(s for p in pieces for s, _ in p)
        for (_, a, _), (n, b, _) in zip(merged, merged[1:]):
            assert n == suffixes.shared(a, b)


# ---- 2 ------------------------------------------------------------------------------------------


def test_base_score_and_model(spark, docs, rows):
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)), F.lit(0)) == 0
    got = hmm.score(docs, held, rounds=2)
    count, end = Counter(), object()
    for i, t, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            count.update([*words(t), end])
    total, distinct = sum(count.values()), len(count)
    by = {r["doc_id"]: r for r in got.collect()}
    assert len(by) == len(rows)
    for i, t, *_ in rows:
        w = [*words(t), end]
        r = by[i]
        assert r["n_tokens"] == len(w) and r["n_known"] == sum(count[x] > 0 for x in w) and r["train_tokens"] == total
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w), rel_tol=1e-9)
    assert sum(r["score"] for r in by.values()) > sum(r["base_score"] for r in by.values())


def test_forward_is_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    model = hmm.Model(norm(rng.random(3)), norm(rng.random((3, 3))), norm(rng.random((3, 5))), np.zeros(0, np.uint64))
    flat, at = np.array([0, 4, 2, 2, 1, 3], np.uint16), np.array([0, 4, 4, 6])
    got = hmm.forward(flat, at, model)
    for k in range(3):
        seq, total = flat[at[k]:at[k + 1]], 0.0
        for path in np.ndindex(*[3] * len(seq)):
            p = 1.0
            for t, s in enumerate(path):
                p *= (model.start[s] if t == 0 else model.move[path[t - 1], s]) * model.emit[s, seq[t]]
            total += p
        assert math.isclose(got[k], math.log(total), abs_tol=1e-12)


def test_training_never_lowers_the_likelihood():
    rng = np.random.default_rng(2)
    flat, at = rng.integers(0, 6, 900).astype(np.uint16), np.arange(0, 901, 90)
    shares = np.full(6, 1 / 6)
    model, before = hmm._fresh(shares, np.zeros(0, np.uint64), 3), -np.inf
    for _ in range(6):
        now = hmm.forward(flat, at, model).sum()
        assert now >= before - 1e-6
        before = now
        start, move, emit = hmm.expected(flat, at, model)
        assert math.isclose(emit.sum(), 900, rel_tol=1e-9) and math.isclose(move.sum(), 890, rel_tol=1e-9)
        model = hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True), model.vocab)


def test_scores_of_nothing(none):
    assert hmm.score(none, F.lit(False), rounds=1).count() == 0


# ---- 3 ------------------------------------------------------------------------------------------


def test_mix_targets_and_cuts(spark, docs, rows):
    sized = docs.drop("size").withColumn("size", mixing.word_count("text"))
    got = [r.asDict() for r in mixing.mix(sized, text="text").collect()]
    assert len(got) == len(rows) and got[0]["frag"] == 7
    sizes = Counter()
    for i, t, _, source in rows:
        sizes[source] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    goal, target = 1.5 * sum(sizes.values()), {}
    open_ = set(order)
    while open_:  # share, stop, share the excess again
        left = goal - sum(target.values())
        each = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if each[s] > 2 * sizes[s]}
        if not over:
            target.update(each)
            break
        target.update({s: 2 * sizes[s] for s in over})
        open_ -= over
    taken = Counter()
    for r in got:
        assert r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], target[r["source"]], rel_tol=1e-9)
        taken[r["source"]] += r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.5
    again = [r.asDict() for r in mixing.mix(sized.repartition(7), text="text").collect()]
    key = lambda r: (r["doc_id"] or -1, r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mix_rows(spark, docs):
    sized = docs.drop("size").withColumn("size", mixing.word_count("text"))
    mixed = mixing.mix(sized, text="text").cache()
    out = mixing.expand(mixed, chars="n_chars").collect()
    assert sum(len(words(r["text"])) for r in out) == mixed.agg(F.sum("taken")).first()[0]
    source = {r["doc_id"]: r["text"] for r in sized.collect()}
    assert all(source[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) for r in out)


def test_mix_empty(none):
    assert mixing.mix(none.drop("size").withColumn("size", mixing.word_count("text"))).count() == 0


# ---- 4 and 5 ------------------------------------------------------------------------------------


def test_codes_round_trip():
    rng = np.random.default_rng(4)
    for ids in ([], [0], [255, 256, 65535, 65536, 2 ** 32 - 1], rng.integers(0, 50257, 3000), rng.integers(0, 2 ** 32, 700)):
        ids = np.array(ids, np.uint32)
        codes = dac.Codes(dac.encode(ids))
        assert (codes.all() == ids).all() and len(codes) == len(ids)
        assert [codes[i] for i in range(len(ids))] == ids.tolist()


def test_token_files(spark, docs, rows, tmp_path):
    dac.write(docs.unionByName(docs.where("doc_id = 3")), str(tmp_path / "ids"), BPE, 2)
    got = sorted((r for r in dac.read(spark, str(tmp_path / "ids")).collect()), key=lambda r: r["start"])
    tok, start = tokens.tokenizer(BPE), 0
    every = sorted([(r[0], r[1]) for r in [*rows, rows[3]]], key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(every)
    for r, (i, t) in zip(got, every):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["key"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files_empty(spark, none, tmp_path):
    dac.write(none, str(tmp_path / "ids"), BPE, 2)
    assert dac.read(spark, str(tmp_path / "ids")).count() == 0


ODD_TEXTS = ["", " ", "a  b", "x<|endoftext|> y", " \n\n a\n", "don't 's  'll we'll", "<|endoftext|>", "a\x1c b", " a\t\tb  ", "a  b",
             "aaaaaaaaaaaaaaaa", "==========  ----", "日本語 漢字", "naïve café—ok", "1234567 89,10", "the<|endo"]


def test_ids_and_counts_equal_the_library():
    rng = random.Random(2)
    texts = ODD_TEXTS + ["".join(rng.choice("abcde tion'the  \n.,é1") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    tok, column = tokens.tokenizer(BPE), pa.array(texts, pa.large_string())
    ids, at = tokens.token_ids(column, BPE)
    _, spot, sums = tokencounts.unit_counts(column, BPE)
    for i, t in enumerate(texts):
        want = tok.encode(t, add_special_tokens=False).ids
        assert ids[at[i]:at[i + 1]].tolist() == want and sums[spot[i + 1]] - sums[spot[i]] == len(want)
    for t in texts[:60]:
        assert tokencounts.prefix_counts(t, BPE) == [len(tok.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]


def test_counts_and_truncation(spark, docs, rows):
    tok = tokens.tokenizer(BPE)
    counted = tokencounts.count_tokens(docs, BPE)
    for r in counted.collect():
        assert r["n_tokens"] == len(tok.encode(r["text"] or "", add_special_tokens=False).ids) and r["n_bytes"] == len((r["text"] or "").encode())
    cut = tokencounts.truncate(docs.where("doc_id < 30 or text is null"), BPE, 9).collect()
    for r in cut:
        t = r["text"] or ""
        fits = [i for i in range(len(t) + 1) if len(tok.encode(t[:i], add_special_tokens=False).ids) <= 9]
        assert r["cut_chars"] == max(fits) and r["cut_tokens"] <= 9


def test_counts_empty(none):
    assert tokencounts.count_tokens(none, BPE).count() == 0


# ---- 6 ------------------------------------------------------------------------------------------


def distance_within(p, t):
    row = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        cur = [i]
        for j in range(1, len(t) + 1):
            cur.append(min(row[j] + 1, cur[-1] + 1, row[j - 1] + (p[i - 1] != t[j - 1])))
        row = cur
    return min(row)


def test_leaks(spark):
    rng = random.Random(6)
    item = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))
    items = [(i, item(rng.randint(1, 25))) for i in range(12)] + [(12, None), (13, " "), (14, "tiny")]
    texts = []
    for k in range(80):
        parts = [item(rng.randint(0, 12))]
        if rng.random() < 0.7:
            t = list(items[rng.randrange(12)][1].upper() if rng.random() < 0.2 else items[rng.randrange(12)][1])
            for _ in range(rng.randint(0, 14)):
                at = rng.randrange(len(t) + 1)
                t[at:at + rng.randint(0, 1)] = rng.choice(["", "x", " "])
            parts.append("".join(t))
        parts.append(item(rng.randint(0, 12)))
        texts.append((k, "\n ".join(parts)))
    texts += [(None, items[3][1]), (90, None), (91, ""), (92, "has tiny in it"), (92, "has tiny in it")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for i, t in texts:
        for j, x in items:
            x = leaks.normal(x)
            if x:
                e, k = distance_within(x, leaks.normal(t)), leaks.budget_of(len(x), leaks.RATE)
                if e <= k:
                    want.add((i, j, e, k))
    for chars in (1 << 20, 400):  # in one block of items, and in many
        got = leaks.annotate(docs, bench, block_chars=chars).collect()
        assert len(got) == len(texts)
        assert {(r["doc_id"], x["item_id"], x["edits"], x["budget"]) for r in got for x in r["leaks"]} == want
    assert any(e for _, _, e, _ in want) and leaks.annotate(docs.limit(0), bench).count() == 0
    assert leaks.annotate(docs, bench.limit(0)).where("size(leaks) > 0").count() == 0


# ---- 7 ------------------------------------------------------------------------------------------


def test_boilerplate(spark):
    page = lambda i, host, *lines: (i, host and f"https://u@{host}:80/p{i}?q", "".join(f"<p>{x}</p>" for x in lines) + "<script>var a='<p>menu</p>'</script><!-- c -->", 1)
    rows = [page(i, "A.example", "menu", f"own <b>{i}</b> text", "menu", "rare" if i < 2 else "x  y") for i in range(10)]
    rows += [page(20 + i, "b.example", "menu", "same") for i in range(2)] + [(30, None, None, 1), (31, "nonsense", "", 1), (32, None, "<p>a</p>", 1)]
    got = {r["page_id"]: r for r in boilerplate.drop_boilerplate(spark.createDataFrame(rows, "page_id long, url string, html string, lines int")).collect()}
    assert len(got) == len(rows)
    assert got[0]["host"] == "a.example" and got[0]["kept"] == "own 0 text\nrare" and got[0]["n_lines"] == 4 and got[0]["n_dropped"] == 2
    assert got[5]["kept"] == "own 5 text"
    assert got[20]["kept"] == "menu\nsame"  # too few pages to tell
    assert (got[30]["host"], got[30]["n_lines"], got[32]["kept"]) == ("", 0, "a")


# ---- 8 ------------------------------------------------------------------------------------------


def test_quality(spark, docs, rows):
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        t = t or ""
        w = [x.decode() for x in t.encode().split()]
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        count, hit = Counter(grams), set()
        for k, g in enumerate(grams):
            if count[g] > 1:
                hit |= {k, k + 1, k + 2}
        lines = [x for x in t.split("\n") if x.encode().split()]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(hit))
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert r["base_failed"] == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    assert quality.judge(docs).where("kept").count() == sum(r["kept"] for r in got.values())


def test_quality_order_does_not_change_the_verdict(docs):
    given = quality.rules()
    one = {(r["doc_id"], r["kept"]) for r in quality.judge(docs, given=given).collect()}
    two = {(r["doc_id"], r["kept"]) for r in quality.judge(docs, given=given[::-1]).collect()}
    assert one == two


def test_quality_empty(none):
    assert quality.judge(none).count() == 0


# ---- 9 ------------------------------------------------------------------------------------------


def test_language(spark, docs, rows):
    net = langid.train(docs, F.coalesce(F.pmod("doc_id", F.lit(4)), F.lit(0)) != 2)
    got = langid.identify(docs, net).collect()
    assert len(got) == len(rows)
    right = total = 0
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert r["lang_pred"] == "und"
        else:
            assert r["lang_pred"] in ("en", "fr")
            if r["doc_id"] is not None and r["doc_id"] % 4 == 2 and len(r["text"]) > 40:
                total += 1
                right += r["lang"] == r["lang_pred"]
    assert total > 10 and right / total > 0.95


def test_language_of_nothing(none, docs):
    assert langid.train(none, F.lit(True)) is None
    assert langid.identify(none, None).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}


def test_training_gradients():
    rng = np.random.default_rng(0)
    net = langid._fresh(["a", "b", "c"], rng)
    codes, y = rng.integers(1, 257, (5, 40)).astype(np.int16), np.array([0, 1, 2, 0, 1])
    loss = lambda: -net.log_probs(codes)[np.arange(5), y].mean()
    for w, g in zip(langid._weights(net), langid._step(net, codes, y)):
        spots = np.argsort(-np.abs(g).ravel())[:3]
        for i in spots:
            keep, eps = w.ravel()[i], 1e-2
            w.ravel()[i] = keep + eps
            up = loss()
            w.ravel()[i] = keep - eps
            down = loss()
            w.ravel()[i] = keep
            assert abs((up - down) / (2 * eps) - g.ravel()[i]) < 0.05 * abs(g.ravel()[i]) + 2e-3


# ---- 10 -----------------------------------------------------------------------------------------


def linked_by_hand(rows, width=3, percent=90):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def chain(seed=8, n=160):
    """Near copies of near copies, so that links reach far beyond any one document."""
    rng = random.Random(seed)
    rows, base = [], [f"w{rng.randint(0, 400)}" for _ in range(140)]
    for i in range(n):
        if rng.random() < 0.15:
            base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([4, 9, 12, 30, 90, 200]))]
        w = list(base)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 9999)}"
        rows.append((i, " ".join(w)))
        if rng.random() < 0.5:
            base = w
    return rows


@pytest.mark.parametrize("block", [4096, 8])
def test_jaccard(spark, docs, rows, monkeypatch, block):
    monkeypatch.setattr(jaccard, "GROUP_BLOCK", block)
    near = [(1000 + i, t) for i, t in chain()]
    want = linked_by_hand([(r[0], r[1]) for r in rows if r[0] is not None] + near)
    frame = docs.select("doc_id", "text", "frag").unionByName(spark.createDataFrame(near, "doc_id long, text string").withColumn("frag", F.lit(1)))
    frame = frame.unionByName(frame.where("doc_id < 4"))
    got = [r for r in jaccard.near_components(frame).collect()]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None]
    assert len({c for _, c in want.values()}) < len(want) - 60


def test_jaccard_of_an_id_with_two_texts(spark):
    base = [f"w{i}" for i in range(60)]
    shared, near = " ".join(base), " ".join([*base[:-1], "other"])
    key = lambda t: jaccard.digests(*jaccard.sets_of(pa.array([t], pa.large_string()), 3)[::2])[0]
    own = next(t for t in (f"its own text number {i}" for i in range(1000)) if key(t) < key(shared))
    frame = spark.createDataFrame([(1, shared), (5, shared), (1, own), (9, near)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_components(frame).collect()}
    assert got == {1: 1, 5: 5, 9: 5}


def test_jaccard_empty(none):
    assert jaccard.near_components(none).count() == 0


def test_remembered_units_are_exact_when_full(spark):
    """A memory far too small forgets and places anew; ids stay those of the library."""
    rng = random.Random(5)
    tok, memory = tokens.tokenizer(BPE), tokens.Remembered(units=60, ids=200, slots=128)
    vocab = [f" {rng.choice('abcde')}{rng.randint(0, 400)}x" for _ in range(300)] + ["", " the", "\n", " é" * 40]
    for _ in range(60):
        names = sorted({rng.choice(vocab[: rng.choice([20, 300])]) for _ in range(50)}) + [" é" * 40]
        offsets, values = memory.lists(text.plain(pa.array(sorted(set(names)))), tok)
        for i, name in enumerate(sorted(set(names))):
            assert values[offsets[i]:offsets[i + 1]].tolist() == tok.encode(name, add_special_tokens=False).ids
        assert memory.n <= 60 and memory.ends[memory.n] <= 200
    assert memory.n > 0


def test_token_at_any_place(spark, docs, rows):
    """Single ids through the rank directories, against the library's ids of the whole corpus."""
    path = work_path(spark, "codes")
    dac.write(docs, path, BPE, 2)
    tok, every = tokens.tokenizer(BPE), []
    texts = {r[0]: r[1] for r in rows}
    for i in sorted(texts, key=lambda i: (i is not None, i)):
        every += [*tok.encode(texts[i] or "", add_special_tokens=False).ids, 2]
    rng = random.Random(2)
    asked = [0, len(every) - 1, len(every), -1, None, *(rng.randrange(len(every)) for _ in range(500))] + [7, 7]
    got = dac.token_at(spark, path, spark.createDataFrame([(p, "x") for p in asked], "position long, token string")).collect()
    assert Counter(r["position"] for r in got) == Counter(asked)
    assert all(r["token"] == (every[r["position"]] if r["position"] is not None and 0 <= r["position"] < len(every) else None) for r in got)
    ids = np.array([*range(0, 70000, 7), 1 << 31, 5], np.uint32)
    codes = dac.Codes(dac.encode(ids))
    assert (codes.at(np.arange(len(ids))) == ids).all() and [codes[i] for i in range(0, len(ids), 97)] == ids[::97].tolist()


@pytest.mark.parametrize("gaps", [False, True])
def test_blocks_of_a_batch_read_as_the_whole(gaps):
    """Words, shingles and bytes of slices, with and without nulls, are those of the texts themselves."""
    rng = random.Random(12)
    values = [None if gaps and rng.random() < 0.2 else " ".join(rng.choice(["Ab", "c", "É", "dEf\n", ""]) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(values, pa.string())], ["text"])
    got = []
    for block in text.blocks(iter([batch]), limit=700):
        texts = text.plain(block.column("text"))
        flat, at = text.words(texts)
        parts = flat.to_pylist()
        got += [parts[a:b] for a, b in zip(at, at[1:])]
        body, ends = text.raw(texts)
        assert bytes(body) == "".join(t or "" for t in block.column("text").to_pylist()).encode() and ends[0] == 0
    assert got == [[w.decode() for w in (t or "").encode().lower().split()] for t in values]


def test_near_copies_in_large_batches(spark):
    """More text than a block holds: the links are those of brute force, and no others."""
    rng = random.Random(20)
    rows = []
    for i in range(1500):
        t = [f"W{rng.randint(0, 5000)}" for _ in range(700)]
        if i % 5 == 4:
            t = rows[-rng.randint(1, 3)][1].split(" ")
            t[rng.randrange(700)] = "changed"
        rows.append((i, " ".join(t)))
    assert sum(len(t) for _, t in rows) > jaccard.BLOCK
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_components(docs).collect()}
    assert got == linked_by_hand(rows)
    assert len({c for _, c in got.values()}) < 1300


def test_prefixes_of_any_text():
    """Every prefix against the library: no-break spaces, runs of white space, contractions, parts of special texts."""
    rng = random.Random(31)
    tok, counter = tokens.tokenizer(BPE), tokencounts.counter(BPE)
    parts = [" ", "  ", "\n", " \n ", "\t", "'", "'re", "'ll", "n't", "word", " Lorem", "é", "東京", "😀", "123", " 45", "!!", " ...", " ", "\x85",
             "<|endoftext|>", "<|endof", "x" * 30, " " * 9, " 'd"]
    for _ in range(150):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        want = [len(tok.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert counter.prefixes(t) == want == tokencounts.prefix_counts(t, BPE), repr(t)


def test_long_odd_text_is_cut_in_time(spark):
    rng = random.Random(1)
    t = " ".join(" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(2000)) for _ in range(30))
    start = time.process_time()
    counts = tokencounts.counter(BPE).prefixes(t)
    assert time.process_time() - start < 20 and len(counts) == len(t) + 1
    tok = tokens.tokenizer(BPE)
    assert counts[-1] == len(tok.encode(t, add_special_tokens=False).ids)
    for i in rng.sample(range(20_000), 5):
        assert counts[i] == len(tok.encode(t[:i], add_special_tokens=False).ids)
    row = tokencounts.truncate(spark.createDataFrame([(1, t)], "doc_id long, text string"), BPE, 512).first()
    assert row["cut_tokens"] == counts[row["cut_chars"]] == 512 and min(counts[row["cut_chars"] + 1:]) > 512
