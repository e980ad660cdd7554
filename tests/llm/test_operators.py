"""Each operator against a brute-force version, on whole tables of sf0.001 and on a table of odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers as P
from graphloom.llm import bpe, chat, exact, langid, packing, pii, quality, queries, suffix, tokens, words
from graphloom.llm.minhash import near_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def long_text(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéßñ") for _ in range(r.randint(1, 9))) for _ in range(n))


BASE = long_text(1, 300)
ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "x"), (4, "x"), (5, "ab" * 20_000), (6, BASE), (7, BASE), (8, BASE.replace("a", "A", 3)),
    (9, BASE[:900] + " changed words here " + BASE[900:]), (10, long_text(2, 50) + BASE[200:500] + long_text(3, 50)), (11, "12345 678"), (None, "no id"), (None, None),
    (12, "<|endoftext|> don't <|im_end|> ½ ①\x85　ß"), (13, "a@b@c.com 1.2.3.4 4111 1111 1111 1111 +49 (30) 1234567"), (14, "one"), (15, "one"), (15, "one"), (16, "😀" * 300 + BASE[:400]),
]


@pytest.fixture(scope="module")
def odd(spark):
    schema = T.StructType([T.StructField("DOC_ID", T.StringType()), T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("Text", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("n", T.LongType()), T.StructField("label", T.LongType())])
    return spark.createDataFrame([(str(d), d, t, 7, None if d is None or d % 5 == 0 else "en", 1, 2) for d, t in ODD], schema).repartition(3)


@pytest.fixture(scope="module")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="module")
def rows(documents):
    return [(r.doc_id, r.text or "") for r in documents.collect()]


def both(odd, documents, rows):
    return [(odd, [(d, t or "") for d, t in ODD]), (documents, rows)]


def empty(df):
    return df.limit(0)


# 1 ------------------------------------------------------------------------------------------------


def suffix_brute(rows, length=100):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest())):
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def suffix_rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.suffix_dedup(df).collect()), key=str)


def test_suffix_dedup(odd, documents, rows):
    for df, own in both(odd, documents, rows):
        assert suffix_rows(df) == suffix_brute(own)
    assert suffix.suffix_dedup(empty(odd)).count() == 0


def random_texts(seed, n):
    r = random.Random(seed)
    parts = ["".join(r.choice("ab ") for _ in range(r.randint(20, 400))) for _ in range(30)]
    return [(i, "".join(r.choice(parts)[r.randint(0, 60) :] for _ in range(r.randint(0, 12)))) for i in range(n)]


def test_suffix_dedup_random(spark):
    own = random_texts(5, 80)
    assert suffix_rows(spark.createDataFrame(own, "doc_id long, text string").repartition(7)) == suffix_brute(own)


def test_suffix_dedup_hot_groups(spark):
    """A phrase among ever different words, in parts smaller than its group."""
    r = random.Random(8)
    phrase = "the same forty bytes of boilerplate text.. "
    own = [(i, "".join(f"{long_text(r.randint(0, 10**6), 6)} {phrase}{'tail ' * r.randint(0, 40)}" for _ in range(r.randint(1, 4)))) for i in range(90)]
    df = spark.createDataFrame(own, "doc_id long, text string").repartition(5)
    got = sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix.suffix_dedup(df, hot_group=7).collect()), key=str)
    assert got == suffix_brute(own) == suffix_rows(df)


def test_suffix_dedup_repeated_ids(spark):
    """Rows of one id are documents of their own, in any row order and partitioning."""
    own = [(None if i % 13 == 0 else i % 7, t) for i, t in random_texts(6, 60)]
    own += own[:20]
    want = suffix_brute(own)
    for seed, n in ((1, 1), (2, 5), (3, 9)):
        random.Random(seed).shuffle(own)
        assert suffix_rows(spark.createDataFrame(own, "doc_id long, text string").repartition(n)) == want


def test_loser_tree():
    r = random.Random(3)
    words = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 12))) for _ in range(500)]
    runs = [sorted(words[i::7]) for i in range(7)]
    coded = [[(suffix.common(a, b, 0), b) for a, b in zip([b"", *run], run, strict=False)] for run in runs]
    out = list(suffix.LoserTree([iter(c) for c in coded]))
    assert [x[1] for _, x in out] == sorted(words)
    assert [s for s, _ in out[1:]] == [suffix.common(a, b, 0) for a, b in zip(sorted(words), sorted(words)[1:], strict=False)]


# 2 ------------------------------------------------------------------------------------------------


def near_brute(rows, width, percent=80):
    sets = {}
    for d, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    label = {d: d for d in sets}
    ids = sorted(sets)
    pairs = defaultdict(int)
    holds = defaultdict(list)
    for d in ids:
        for s in sets[d]:
            holds[s].append(d)
    for ds in holds.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                pairs[a, b] += 1

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            label[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_near_dedup_repeated_ids(spark):
    """Four rows of three ids: links are those between rows, whatever their order."""
    a, b = long_text(21, 80), long_text(22, 80)
    own = [(1, a), (2, a + " more"), (2, b), (3, b + " end"), (4, a), (4, a), (None, a), (None, None), (5, ""), (5, "")]
    want = sorted(
        [(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (4, 1, False), (4, 1, False), (None, None, True), (None, None, True), (5, 5, True), (5, 5, True)], key=str
    )
    for seed, n in ((1, 1), (2, 3), (3, 7), (4, 2)):
        random.Random(seed).shuffle(own)
        got = near_dedup(spark.createDataFrame(own, "doc_id long, text string").repartition(n), width=2).collect()
        assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == want


@pytest.mark.parametrize("width", [2, 5])
def test_near_dedup(odd, documents, rows, width):
    for df, own in both(odd, documents, rows):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup(df, width=width).collect() if r.doc_id is not None}
        assert got == near_brute([r for r in own if r[0] is not None], width)
    assert near_dedup(empty(odd)).count() == 0


def test_near_dedup_chains_of_copies(spark):
    r = random.Random(9)
    base, own = [f"w{r.randint(0, 5000)}" for _ in range(200)], []
    for i in range(120):
        w = list(base)
        for _ in range(r.randint(0, 14)):
            w[r.randrange(len(w))] = f"v{r.randint(0, 99999)}"
        own.append((i, " ".join(w)))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup(spark.createDataFrame(own, "doc_id long, text string"), width=2).collect()}
    want = near_brute(own, 2)
    assert got == want


# 3, 10 --------------------------------------------------------------------------------------------


def test_count_tokens(odd, documents, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for df, own in both(odd, documents, rows):
        got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(df, P.path("byte_bpe_50k.json")).collect())
        want = sorted((d or -1, len(t.encode()), n := len(tok.encode(t, add_special_tokens=False)), n > 1024) for d, t in own)
        assert got == want
    assert tokens.count_tokens(empty(odd), P.path("byte_bpe_50k.json")).count() == 0


def test_tiers_take_every_script():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = ["“curly” — don’t … 5 €", "Привет мир, привет ещё раз", "漢字かな混じり文。漢字かな", "เฮลโล เวิลด์ 12", "x\x85y\x1cz\xa0\u3000 tab\t", "plain text is plain"]
    pre = words.PreTokens(path, tok)
    tiers = tokens.Tiers({k: len(v) for t in texts[:3] for k, v in zip(pre.cut(t), pre.learn(pre.cut(t)), strict=True)}, pre)
    for t in texts:
        assert not pre.whole(t) and tiers.count(t) == len(tok.encode(t, add_special_tokens=False))
    assert tiers.second and len(tiers) > 10 and not any(k in tiers.second for k in tiers)
    assert tiers.count("a <|endoftext|> b") == len(tok.encode("a <|endoftext|> b", add_special_tokens=False))
    other = tokens.Tiers({}, words.PreTokens(P.path("word_bpe_49k.json"), Tokenizer.from_file(P.path("word_bpe_49k.json"))))
    for t in texts:
        assert other.count(t) == len(other.pre.tok.encode(t, add_special_tokens=False))


def test_parts_leave_tokens_whole():
    t = long_text(8, 4000) + "\n\n x  y — " * 50
    got = words.parts(t, 1000)
    assert "".join(got) == t and len(got) > 10 and max(map(len, got)) < 2000
    cut = words.BYTE_LEVEL.findall
    assert [w for p in got for w in cut(p)] == cut(t)


def test_bpe_unspaced_scripts():
    """Long pre-tokens of unspaced scripts, base64 and addresses, in bounded memory and equal to the library; other patterns."""
    import tiktoken

    r, path = random.Random(12), P.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.read_ranks(path)

    def sentences(lo, hi, n, size):
        return "".join("".join(chr(r.randint(lo, hi)) for _ in range(r.randint(*size))) + r.choice("。、 !\n") for _ in range(n))

    def letters(n):
        return "".join(r.choice("ABCDEFabcdefghij0123456789+/") for _ in range(n))

    texts = [sentences(0x4E00, 0x9FA0, 600, (30, 60)), sentences(0xE01, 0xE2E, 300, (20, 90)), letters(150_000), " ".join(f"https://{letters(9)}.org/{letters(40)}?q={letters(30)}" for _ in range(1000)), "a" * 3000, "acgt" * 1500, "x" * 6000, " " * 500, ""]
    texts.append(texts[0] * 60)  # megabytes of it
    for pattern in (P.PATTERN, r"\S+|\s+"):
        codec = bpe.Codec(path, pattern)
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        some = texts if pattern == P.PATTERN else ["ab12 cd", "don't 12x", texts[0][:50]]
        ids = codec.encode(some)
        assert all(x.tolist() == enc.encode_ordinary(t) for t, x in zip(some, ids, strict=True))
        assert codec.decode(ids) == [t.encode() for t in some]


def test_bpe(odd, documents, rows):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    for df, own in both(odd, documents, rows):
        got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe(df, path, P.PATTERN).collect())
        want = []
        for d, t in own:
            ids = enc.encode_ordinary(t)
            want.append((d or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
        assert got == sorted(want)
    assert bpe.bpe(empty(odd), path, P.PATTERN).count() == 0


# 4 ------------------------------------------------------------------------------------------------


def test_exact_dedup(odd, documents, rows):
    for df, own in both(odd, documents, rows):
        groups = defaultdict(list)
        for d, t in own:
            groups[t].append(d)
        top = {t: max((d for d in ds if d is not None), default=None) for t, ds in groups.items()}
        want = sorted(str((d, top[t], len(groups[t]), d == top[t], hashlib.sha256(t.encode()).hexdigest())) for d, t in own)
        assert sorted(str(tuple(r)) for r in exact.exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == want
    assert exact.exact_dedup(empty(odd)).count() == 0


def test_exact_dedup_small_filter(spark):
    own = [(i, f"t{i % 700}" if i % 3 else f"own {i}") for i in range(3000)]
    got = exact.exact_dedup(spark.createDataFrame(own, "doc_id long, text string"), max_bits=1 << 10)
    assert got.filter("kept").count() == len({t for _, t in own})


# 5 ------------------------------------------------------------------------------------------------


def test_pack(odd, documents, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for df, own in both(odd, documents, rows):
        got = queries.pack_documents(df).collect()
        want = []
        for d, t in own:
            ids = [*tok.encode(t, add_special_tokens=False).ids, 1]
            want += [(d or -1, k, k * 4096, len(p := ids[k * 4096 : (k + 1) * 4096]), zlib.crc32(np.array(p, "<u4").tobytes())) for k in range(math.ceil(len(ids) / 4096))]
        assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
        by = defaultdict(list)
        for r in got:
            by[r.sequence_id].append((r.offset, r.length))
        for parts in by.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 4096
        total = sum(r.length for r in got)
        assert len(by) <= 1.03 * math.ceil(total / 4096) + 1
    assert queries.pack_documents(empty(odd)).count() == 0


def test_best_fit_is_close_to_the_bound():
    r = np.random.default_rng(0)
    sizes, counts = np.unique(np.minimum(4095, r.lognormal(6, 1, 20000).astype(int) + 1), return_counts=True)
    _, n = packing.best_fit(dict(zip(sizes.tolist(), counts.tolist(), strict=True)), 4096)
    assert n <= 1.002 * math.ceil((sizes * counts).sum() / 4096) + 1


# 6 ------------------------------------------------------------------------------------------------


def base_brute(t):
    w = WORD.findall(t)
    lines, dup, seen = t.split("\n"), 0, set()
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    wins = defaultdict(list)
    for i in range(len(w) - 4):
        wins[tuple(w[i : i + 5])].append(i)
    covered = {j for at in wins.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed


def test_quality_rules(spark, odd, documents, rows, data):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    for df, own in both(odd, documents, rows):
        got = quality.quality_rules(df, labels).collect()
        assert sorted((r.doc_id or -1, *r[1:7]) for r in got) == sorted((d or -1, *base_brute(t)) for d, t in own)
        assert not any(r.kept for r in got if r.base_failed)
    assert quality.quality_rules(empty(odd), labels).count() == 0
    assert quality.quality_rules(odd, empty(labels)).count() == len(ODD)


def test_verdicts_on_labels_not_seen(spark):
    """Rules learned from half of the labels judge the other half: they catch bad documents and leave good ones."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = quality.quality_rules(docs, labels.filter(half)).join(labels.filter(~half), "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert len(good) > 100 and len(bad) > 15 and np.mean(good) > 0.9 and np.mean(bad) < 0.4


def test_repeated_and_null_labels(spark, documents):
    labels = spark.createDataFrame([(i % 20, i % 2) for i in range(200)] + [(None, 0), (3, None)], "doc_id long, quality int")
    once = quality.quality_rules(documents, labels).collect()
    assert len(once) == documents.count()
    assert sorted(map(str, once)) == sorted(map(str, quality.quality_rules(documents.repartition(5), labels.repartition(3)).collect()))


def test_decision_list_learns_a_conjunction():
    r = np.random.default_rng(1)
    x = {"a": r.random(3000), "b": r.random(3000), "c": r.random(3000)}
    bad = (x["a"] > 0.7) & (x["b"] < 0.4)
    rules = quality.learn(x, bad)
    found = np.any([np.all([lit.covers(x) for lit in rule], axis=0) for rule in rules], axis=0)
    assert (found == bad).mean() > 0.98


def test_verdict_column_equals_rules(spark):
    rules = [(quality.Literal("n_words", False, 3.0),), (quality.Literal("symbols_per_word", True, 0.5), quality.Literal("n_words", True, 5.0))]
    df = spark.createDataFrame([(2, 9), (8, 4), (8, 1)], "n_words long, n_symbols long").withColumns({c: F.lit(1) for c in ["word_chars", "n_dup_lines", "n_lines", "n_repeat_words", "n_upper", "n_digits", "n_distinct_words"]})
    assert [r.v for r in df.select(quality.verdict(rules).alias("v")).collect()] == [0, 1, -1]


# 7 ------------------------------------------------------------------------------------------------


def test_language_id(spark, odd, documents):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out()
    got = langid.identify(df, df.filter(~held)).withColumn("held", held)
    truth = got.join(df.select("doc_id", "lang").dropDuplicates(["doc_id"]), "doc_id").filter("held and lang is not null and lang_pred <> 'und'")
    r = truth.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.a > 0.95 and 0 <= r.lo <= r.hi <= 1
    out = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, documents).collect()}
    assert len(out) == len({d for d, _ in ODD}) and all(out[d] == ("und", 0.0) for d in (0, 1, 2, 11))
    assert {r.lang_pred for r in langid.identify(odd, empty(documents)).collect()} == {"und"}
    assert langid.identify(empty(odd), documents).count() == 0


def test_language_training_keeps_every_label_and_whole_texts(spark):
    docs = [(None if i % 2 else i, f"{i} word", f"l{i % 260}") for i in range(1300)] + [(5000 + i, f"much {i}", "common") for i in range(2000)]
    docs += [(9000, "boilerplate " * 3000 + "tail" * 100, "long"), (9001, "", "empty"), (9002, "x" * 300, "short")]
    got = langid.training_rows(spark.createDataFrame(docs, "doc_id long, text string, label string"), 600)
    labels = [k for _, k in got]
    assert set(labels) == {k for _, _, k in docs} and max(map(labels.count, set(labels))) == 600 // 264
    windows = {k: [bytes(w) for w in ws] for ws, k in got}
    assert len(windows["long"]) == langid.TRAIN_WINDOWS and b"tail" in windows["long"][-1]
    assert b"".join(windows["short"]) == b"x" * 300 and windows["empty"] == [b""]
    assert {k for _, k in langid.training_rows(spark.createDataFrame(docs, "doc_id long, text string, label string"), 10)} == set(labels)


def test_language_rules_against_brute_force(spark, odd):
    """held_out, the rule for texts without letters, and predictions equal a direct convolution over whole texts."""
    ids = spark.createDataFrame([(i,) for i in [*range(200), -5, 2**40]] + [(None,)], "doc_id long")
    got = {x.doc_id: x.h for x in ids.select("doc_id", langid.held_out().alias("h")).collect()}
    assert got == {i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2 for i in [*range(200), -5, 2**40, None]}
    net = langid.ByteCNN(["a", "b", "c"])
    texts = ["x", "é漢字 word " * 90, "1 a", "y" * langid.WINDOW, "z" * (langid.WINDOW + 1)]
    best, p = net.predict([t.encode() for t in texts], net.tables())
    for t, k, q in zip(texts, best, p, strict=True):
        b, total = t.encode(), np.zeros(3)
        for at in range(0, len(b), langid.WINDOW):
            w = b[at : at + langid.WINDOW]
            x = np.frombuffer(w.ljust(langid.WINDOW, b" "), np.uint8)
            e, pooled = net.p["emb"][x], []
            for width in langid.WIDTHS:
                z = np.array([sum(e[i + j] @ net.p[f"f{width}"][j] for j in range(width)) for i in range(langid.WINDOW - width + 1)])
                pooled.append(z.max(0) + net.p[f"b{width}"])
            z = np.maximum(np.concatenate(pooled), 0) @ net.p["out"] + net.p["bias"]
            total += len(w) * (z - np.log(np.exp(z).sum()))
        mean = np.exp(total / len(b) - (total / len(b)).max())
        assert k == mean.argmax() and abs(q - mean.max() / mean.sum()) < 1e-4
    rows = {x.doc_id: x.lang_pred for x in langid.identify(odd, spark.createDataFrame([(1, "abc def", "en"), (2, "xyz", None), (3, None, "de")], "doc_id long, text string, lang string")).collect()}
    for d, t in ODD:
        if d not in (None, 15):
            assert rows[d] == ("en" if t and any(c.isalpha() for c in t) else "und"), d


def test_network_tables_equal_the_network():
    net = langid.ByteCNN(["a", "b"])
    x = np.random.default_rng(0).integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    e = net.p["emb"][x]
    pooled = []
    for w in langid.WIDTHS:
        t = x.shape[1] - w + 1
        z = sum(e[:, j : j + t] @ net.p[f"f{w}"][j] for j in range(w)) + net.p[f"b{w}"]
        pooled.append(z.max(1))
    z = np.maximum(np.concatenate(pooled, 1), 0) @ net.p["out"] + net.p["bias"]
    assert np.allclose(z - np.log(np.exp(z).sum(1, keepdims=True)), net.log_probabilities(x, net.tables()), atol=1e-4)


# 8 ------------------------------------------------------------------------------------------------


def test_chat_format(spark, data):
    own = queries.op8_chat_format(spark, data).collect()
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{data}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    want = {}
    for c, ts in turns.items():
        ts.sort()
        loss = "".join(t for _, role, t in ts if role == "assistant")
        want[c] = (len(ts), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in ts).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert {r.conv_id: tuple(r)[1:5] for r in own} == want


def test_chat_offsets_equal_the_library():
    tok, size = chat.tokenizer(P.path("byte_bpe_50k.json"))
    for t in ("", "plain text", "é漢字 😀 ½<|im_end|>x\n\n", chat.render([("user", long_text(3, 60)), ("assistant", "😀😀 ₿ <|im_end|>")])[0]):
        e = tok.encode(t, add_special_tokens=False)
        starts, ends = chat.offsets(t, np.array(e.ids, np.int32), size)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [tuple(x) for x in e.offsets]


def test_chat_odd(spark):
    odd = [(1, None, None, None, 0), (1, 2, "assistant", "<\\|x <| <\\\\| <|im_sep|> 😀\n", 0), (1, 2, "assistant", "<\\|x <| <\\\\| <|im_sep|> 😀\n", 0), (None, 1, "assistant", "", 0), (2, 1, "a<|b", " lead", 0), (2, 3, "assistant", "\n\n x <", 0), (2, 4, "assistant", long_text(4, 3000), 0)]
    df = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string, Text int")
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(df, P.path("byte_bpe_50k.json"))).collect()}
    for c in (None, 1, 2):
        ts = sorted(((t if t is not None else -1, r or "", x or "") for k, t, r, x, _ in odd if k == c))
        loss = "".join(x for _, r, x in ts if r == "assistant")
        assert got[c].n_turns == len(ts) and got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in ts).encode()).hexdigest()
    assert chat.format_chats(df.limit(0), P.path("byte_bpe_50k.json")).count() == 0


# 9 ------------------------------------------------------------------------------------------------


def pii_brute(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]
    return sorted(out)


def test_base_patterns_on_random_text():
    r = random.Random(2)
    for _ in range(4000):
        t = "".join(r.choice(["a", "b@", "@", ".", "c.com", "1", "22", "4111111111111111", "1.2.3.4", " ", "-", "+", "+49 30 1234567", "_", "%", "(", "999."]) for _ in range(r.randint(1, 14)))
        assert pii.base_spans(t) == pii_brute(t), t


def test_pii(odd, documents, rows):
    for df, own in both(odd, documents, rows):
        got = pii.digests(pii.find_pii(df)).collect()
        want = []
        for d, t in own:
            s = pii_brute(t)
            text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in s)
            want.append((d or -1, *(sum(k == i for _, k, _ in s) for i in range(4)), hashlib.sha256(text.encode()).hexdigest()))
        assert sorted((r.doc_id or -1, *tuple(r)[1:6]) for r in got) == sorted(want)
    assert pii.find_pii(empty(odd)).count() == 0


def test_field_adds_a_repeat(spark):
    r = random.Random(4)
    docs = []
    for i in range(300):
        mail = f"u{r.randint(100, 999)}@host{r.randint(1, 9)}.org"
        docs.append((i, f"{long_text(i, 12)} write to {mail} or call +49 30 {r.randint(1000000, 9999999)} now {r.randint(1, 99)} times, {long_text(i + 1000, 9)}"))
    mail = "someone7@place.org"
    docs.append((999, f"mail {mail} today. again write to someone7@place·org please, and someone7@placeorg too"))
    got = {x.doc_id: x.spans for x in pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert sum(s.base for s in got[999]) == 1
    assert any(not s.base and s.kind == "email" for s in got[999])
    assert not any(not s.base for k, v in got.items() if k != 999 for s in v)


def field_docs():
    r = random.Random(4)
    docs = []
    for i in range(300):
        mail = f"u{r.randint(100, 999)}@host{r.randint(1, 9)}.org"
        docs.append((i, f"{long_text(i, 12)} write to {mail} or call +49 30 {r.randint(1000000, 9999999)} now {r.randint(1, 99)} times, {long_text(i + 1000, 9)} {r.randint(1, 255)}.{r.randint(1, 255)}.7.{r.randint(1, 255)} in Version {r.randint(1, 9)}.0."))
    mail = "someone7@place.org"
    docs.append((999, f"mail {mail} today. again write to someone7@place·org please, and someone7@place·org too"))
    docs.append((998, "paid with 4111111111111111 4111111111111111 in all"))  # the pattern takes both as one and drops them
    return docs


def test_field_adds_what_patterns_miss(spark):
    got = {x.doc_id: x.spans for x in pii.find_pii(spark.createDataFrame(field_docs(), "doc_id long, text string")).collect()}
    assert sum(s.base for s in got[999]) == 1
    assert any(not s.base and s.kind == "email" for s in got[999])
    assert [(s.kind, s.base) for s in got[998]] == [("card", False)] * 2
    assert not any(not s.base for k, v in got.items() if k < 900 for s in v)


def test_what_patterns_miss_is_not_taught_as_outside():
    for text, labels in (
        ("mail someone7@place.org or someone7@place·org in 7 days", [1, 1, 0]),  # a copy of a base match
        ("paid with 4111111111111111 4111111111111111 in 2 parts", [3, 3, 0]),  # each is a match alone
    ):
        assert pii.lessons(text, 5)[0].label.tolist() == labels


def test_field_does_not_depend_on_layout(spark):
    docs = field_docs()
    want = None
    for seed, n in ((1, 1), (2, 7)):
        random.Random(seed).shuffle(docs)
        got = sorted((r.doc_id, r.spans) for r in pii.digests(pii.find_pii(spark.createDataFrame(docs, "doc_id long, text string").repartition(n), train_docs=50)).collect())
        assert want in (None, got)
        want = got


def field_of(n, ends, seed):
    r = np.random.default_rng(seed)
    crf = pii.SkipChainCRF()
    crf.pair = {k: r.normal(0, 0.7, (pii.LABELS, pii.LABELS)) for k in pii.LINKS}
    own = r.normal(0, 1, (n, pii.LABELS))
    ends = {k: np.array(ends.get(k, []), np.int64).reshape(-1, 2) for k in pii.LINKS}
    exact = np.zeros((n, pii.LABELS))
    for y in np.ndindex(*[pii.LABELS] * n):
        score = sum(own[i, k] for i, k in enumerate(y)) + sum(crf.pair[k][y[a], y[b]] for k, e in ends.items() for a, b in e)
        for i, k in enumerate(y):
            exact[i, k] += math.exp(score)
    return crf, own, ends, exact / exact.sum(1, keepdims=True)


@pytest.mark.parametrize("seed", range(3))
def test_message_passing_equals_enumeration_on_trees(seed):
    crf, own, ends, exact = field_of(5, {"chain": [(0, 1), (1, 2)], "copy": [(0, 3)], "like": [(2, 4)]}, seed)
    assert np.allclose(crf.infer(own, ends, np.full(5, -1), rounds=60), exact, atol=1e-6)


def test_message_passing_is_close_on_a_loop():
    crf, own, ends, exact = field_of(5, {"chain": [(0, 1), (1, 2), (3, 4)], "copy": [(0, 3), (0, 2)], "like": [(2, 4)]}, 5)
    got = crf.infer(own, ends, np.full(5, -1), rounds=60)
    assert np.abs(got - exact).max() < 0.1


# pipeline -----------------------------------------------------------------------------------------


def test_pipeline(spark, data, documents, rows):
    import corpus_pipeline

    docs, before = documents, None
    for name, f in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, f(spark, docs, data).cache()
        assert docs.columns == documents.columns, name
        if name == "exact_dedup":
            assert docs.count() == before.select("text").distinct().count()
        if name == "near_dedup":
            texts = {r.doc_id: r.text for r in before.collect()}
            assert {r.doc_id for r in docs.select("doc_id").collect()} == {d for d, (_, c) in near_brute(list(texts.items()), 5).items() if d == c}
        if name == "pii":
            assert docs.count() == before.count() and not any(pii_brute(r.text) for r in docs.select("text").collect())
    assert corpus_pipeline.run(spark, data).select("doc_id").distinct().count() == docs.count()


PIPE = "doc_id long, text string, lang string, source string, n_chars long, TEXT int"


def pipe_stage(spark, name, rows):
    import corpus_pipeline

    docs = spark.createDataFrame([(d, t, lang, "s", None, 1) for d, t, lang in rows], PIPE).repartition(3)
    got = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
    assert name == "packing" or got.columns == corpus_pipeline.COLUMNS
    return sorted(((r.doc_id, r.text, r.lang) for r in got.collect()) if name != "packing" else [(r.doc_id,) for r in got.collect()], key=str)


def test_pipeline_exact_settles_rows(spark):
    rows = [(1, "x", "en"), (1, "x", "de"), (2, "y", "en"), (3, "y", "en"), (2, "z", "en"), (None, "y", "en"), (None, "w", "en"), (None, "w", "en"), (4, None, "en"), (5, "", "en")]
    assert pipe_stage(spark, "exact_dedup", rows) == sorted([(1, "x", "de"), (3, "y", "en"), (2, "z", "en"), (None, "w", "en"), (5, "", "en")], key=str)
    plain = [(1, "x", "en"), (2, "x", "en"), (3, "q", None)]
    assert pipe_stage(spark, "exact_dedup", plain) == [(2, "x", "en"), (3, "q", None)]


def test_pipeline_near_keeps_whole_documents(spark):
    rows = [(3, BASE, "en"), (5, BASE + " more", "en"), (5, "other words that stand alone here", "en"), (6, BASE + " end", "en"), (None, BASE, "en"), (7, None, None)]
    assert {d for d, _, _ in pipe_stage(spark, "near_dedup", rows)} == {3, 5, 7, None}
    assert len(pipe_stage(spark, "near_dedup", rows)) == 5


def test_pipeline_language_rejects_only_letterless_documents(spark):
    texts = [(1, BASE), (2, "some words"), (3, "123 - 4"), (4, None)]
    assert pipe_stage(spark, "language", [(d, t, None) for d, t in texts]) == [(1, BASE, None), (2, "some words", None)]
    und = [(10 + i, f"{long_text(i, 40)}", "und") for i in range(20)] + [(50, BASE, None), (51, "77", "und")]
    assert pipe_stage(spark, "language", und) == sorted([(d, t, "und") for d, t, _ in und if d != 51], key=str)


def test_pipeline_stages_return_the_heap_of_the_one_before(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "one two three", "en", "s", 13)], "doc_id long, text string, lang string, source string, n_chars long")
    runtime = spark._jvm.java.lang.Runtime.getRuntime()  # of the driver, which runs the tasks here
    for _, stage_of in corpus_pipeline.STAGES:
        spark.range(0, 2, 1, 2).selectExpr("length(repeat(string(id), 300000000)) as n").agg({"n": "sum"}).collect()  # takes heap, keeps none
        before = runtime.totalMemory()
        stage_of(spark, docs, "")
        assert runtime.totalMemory() < before - 200_000_000


@pytest.mark.parametrize("name", ["language", "exact_dedup", "near_dedup", "pii", "packing"])
def test_pipeline_stages_on_odd_tables(spark, name):
    assert pipe_stage(spark, name, []) == []
    rows = [(d, t, "en") for d, t in ODD]
    ids = {r[0] for r in pipe_stage(spark, name, rows)}
    lettered = {d for d, t in ODD if t and any(c.isalpha() for c in t)}
    if name == "language":
        assert ids == lettered
    if name in ("pii", "packing"):
        assert ids == {d for d, _ in ODD}


COLUMNS = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2_minhash_dedup": "doc_id n_shingles component_id kept",
    "op3_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op4_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op5_best_fit": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_language_id": "doc_id held_out lang_pred score",
    "op9_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op10_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_returns_every_document(spark, data, documents, name):
    df = queries.QUERIES[name](spark, data)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    got = [r.doc_id for r in df.select("doc_id").collect()]
    want = sorted(r.doc_id for r in documents.select("doc_id").collect())
    assert (sorted(set(got)) if name == "op5_best_fit" else sorted(got)) == want


def test_oracle_sql(spark, data):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for name, sql in queries.ORACLE.items():
        df = queries.QUERIES[name](spark, data)
        cols = sorted(df.columns)
        assert sorted(map(str, con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall())) == sorted(str(tuple(r)) for r in df.select(*cols).collect())
