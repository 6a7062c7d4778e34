"""Token files, fill-in-the-middle and collocations against plain versions, on sf0.001 and on odd tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tables import make_docs, sf_table, shared_code  # noqa: F401 - fixtures
from tokenizers import Tokenizer

import __spark_entry__ as E
from farelane.llm import collocations, fim, token_store
from farelane.llm import count_automaton as ca
from farelane.llm.bpe import _Codec
from farelane.llm.fragment_table import TableCodec
from farelane.llm.paths import tokenizer_path

SF_SMALL = "/root/testdata/sf0.001"

ODD = [
    (7, "A short one."),
    (3, None),
    (2, ""),
    (5, "  \n\t "),
    (5, "a second text under the same id"),
    (5, "a second text under the same id"),
    (None, "no id"),
    (-4, "below zero <P> with a sentinel"),
    (9, "日本語 テキスト 😀 é ü　x " * 20),
    (11, "word " * 60_000),
    (12, "x" * 200_000),
    (13, "it's 'quoted' I'll we\r\n\n\n  done<|endoftext|>more ÀÖØöøÿ×÷ª"),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


# ---- token files


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=6))
def test_table_codec_is_the_plain_codec(texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    codec = TableCodec(tokenizer_path()) if not hasattr(test_table_codec_is_the_plain_codec, "codec") else test_table_codec_is_the_plain_codec.codec
    test_table_codec_is_the_plain_codec.codec = codec
    ids, first = codec.encode(raw, off)
    for i, t in enumerate(texts):
        assert ids[first[i] : first[i + 1]].tolist() == tokenizer().encode(t, add_special_tokens=False).ids


def test_table_starts_again_when_full(monkeypatch):
    from farelane.llm import fragment_table

    monkeypatch.setattr(fragment_table, "TABLE_FRAGMENTS", 5)
    codec, plain = TableCodec(tokenizer_path()), _Codec(tokenizer_path())
    for text in ("one two three four five six seven eight", "two nine ten one", "one two naïve three"):
        raw = np.frombuffer(text.encode(), np.uint8)
        off = np.array([0, len(raw)])
        assert codec.encode(raw, off)[0].tolist() == plain.encode(raw, off)[0].tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**31), max_size=40), min_size=0, max_size=8), st.sampled_from([(8, 8, 8, 8), (5, 8, 3, 8, 8), (1, 7, 8, 8, 8), (8, 8, 8, 7, 1)]), st.data())
def test_file_round_trip(docs, widths, data):
    ids = np.array([x for d in docs for x in d], np.uint32)
    sizes = np.array([len(d) for d in docs], np.int64)
    blob = token_store.build_file(ids, sizes, np.arange(len(docs)), 0, widths)
    file = token_store.TokenFile(lambda at, size: blob[at : at + size])
    assert file.doc_starts().tolist() == np.concatenate([[0], np.cumsum(sizes)]).astype(int).tolist()
    assert file.read(0, len(ids)).tolist() == ids.tolist()
    lo = data.draw(st.integers(0, len(ids)))
    hi = data.draw(st.integers(lo, len(ids)))
    assert file.read(lo, hi).tolist() == ids[lo:hi].tolist()


def test_file_access_reads_little():
    """A single id takes a few small reads, whatever the size of the file."""
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50_000, 300_000).astype(np.uint32)
    blob = token_store.build_file(ids, np.array([len(ids)]), np.array([1]), 0, (8, 8))
    got = []
    file = token_store.TokenFile(lambda at, size: (got.append(size), blob[at : at + size])[1])
    for i in (0, 511, 512, 513, 77_777, 299_999):
        got.clear()
        assert file.read(i, i + 1)[0] == ids[i]
        assert sum(got) <= 8 + token_store.RANK_BITS // 8 + 4


def test_too_wide_id():
    with pytest.raises(ValueError):
        token_store.build_file(np.array([256], np.uint32), np.array([1]), np.array([0]), 0, (8,))


def plain_tokens(rows):
    """(id, start, n, crc) in file order; equal ids in either order."""
    t = tokenizer()
    return {(i, text): t.encode(text or "", add_special_tokens=False).ids + [0] for i, text in rows}


def test_token_store_on_sf(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in E.queries()["op11_token_store"](spark, SF_SMALL).collect()}
    t, start = tokenizer(), 0
    for doc_id, text in sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        r = rows[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == docs.count()


@pytest.mark.parametrize("file_tokens", [1, 50, 1 << 22])
def test_token_store_on_odd_rows(spark, make_docs, file_tokens):  # noqa: F811
    files = token_store.write_tokens(make_docs(ODD).withColumn("start", F.lit("clash")), tokenizer_path(), partitions=3, file_tokens=file_tokens)
    rows = sorted(token_store.read_documents(files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, -4, 2, 3, 5, 5, 5, 7, 9, 11, 12, 13]
    want = plain_tokens(ODD)
    start, ids = 0, []
    for r in rows:
        own = np.frombuffer(r["ids"], "<u4").tolist()
        assert own in [x for (i, _), x in want.items() if i == r["doc_id"]]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(bytes(r["ids"])))
        start += len(own)
        ids += own
    asked = [0, 1, start - 1, start // 2, start // 2, start, -1, None]
    got = token_store.lookup(files, spark.createDataFrame([(x,) for x in asked], "position long")).collect()
    assert sorted((r["position"], r["token_id"]) for r in got) == sorted((x, ids[x]) for x in asked[:5])


def test_token_store_empty_table(spark, make_docs):  # noqa: F811
    files = token_store.write_tokens(make_docs([]), tokenizer_path(), partitions=2)
    assert files.count() == 0 and token_store.read_documents(files).count() == 0
    assert token_store.lookup(files, spark.createDataFrame([(0,)], "position long")).count() == 0


# ---- fill in the middle


def plain_fim(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def fim_rows(doc_ids):
    texts = [t for _, t in ODD]
    return [(i, texts[k % len(texts)]) for k, i in enumerate(doc_ids)]


def test_fim_against_plain(spark, make_docs):  # noqa: F811
    rows = ODD + fim_rows(range(100, 220))
    got = fim.digests(make_docs(rows).withColumn("form", F.lit("clash"))).collect()
    want = Counter()
    for i, text in rows:
        n, form, p, m, out = plain_fim(i, text)
        want[(i, n, form, p, m, sha(out), sha(text or ""))] += 1
    assert Counter((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) for r in got) == want
    assert {"plain", "spm", "psm"} == {r["form"] for r in got}


def test_fim_texts_and_pieces(spark, make_docs):  # noqa: F811
    rows = ODD + fim_rows(range(100, 180))
    made = fim.unrender(fim.render(fim.rearrange(make_docs(rows)))).collect()
    assert Counter((r["doc_id"], r["output"], r["restored"]) for r in made) == Counter((i, plain_fim(i, t)[4], t or "") for i, t in rows)
    for r in made:
        size = sum(p["length"] for p in r["pieces"] if p["buffer"] == fim.TEXT)
        assert size == len((r["text"] or "").encode())
        assert sum(p["buffer"] == fim.MARKS for p in r["pieces"]) == (0 if r["form"] == "plain" else 3)


def test_fim_empty_table(make_docs):  # noqa: F811
    assert fim.digests(make_docs([])).count() == 0


@given(st.lists(st.integers(1, 9), min_size=1, max_size=5), st.data())
def test_cut_keeps_the_bytes(lengths, data):
    text = bytes(range(sum(lengths)))
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1].tolist()
    pieces = [(fim.TEXT, s, n) for s, n in zip(starts, lengths, strict=True)]
    at = data.draw(st.integers(0, len(text)))
    left, right = fim.cut(pieces, at)
    assert b"".join(fim.stream(left, text)) == text[:at] and b"".join(fim.stream(right, text)) == text[at:]


def test_restore_rejects_other_texts():
    with pytest.raises(ValueError):
        fim.restore(b"no sentinel", "psm")


# ---- collocations


def plain_collocations(rows, min_count, top):
    grams, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        f = grams.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                f.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in grams.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in cand.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        best = []
        for p, a in cand.items():
            if 100 * longer[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def spark_collocations(df, **kw):
    cols = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return sorted(tuple(r[c] for c in cols) for r in collocations.collocations(df, **kw).collect())


def test_collocations_on_sf(spark):
    rows = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert spark_collocations(docs, min_count=5, top=50) == plain_collocations(rows, 5, 50)
    got = E.queries()["op13_collocations"](spark, SF_SMALL)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 30, 2000)


def word_rows(seed, n):
    rng = np.random.default_rng(seed)
    words = ["the", "of", "a", "b", "New", "york", "é", "日本", "x y", "q" * 500]
    rows = []
    for i in range(n):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  "])) for _ in range(rng.integers(0, 60)))
        rows.append((str(rng.choice(["en", "fr", ""])) if i % 7 else None, text if i % 11 else None))
    return rows + [("und", "of the of the"), ("en", "the of " * 20_000), ("en", "the of " * 20_000)]


@pytest.mark.parametrize("partitions", [1, 3])
def test_collocations_over_many_ranges(spark, monkeypatch, partitions):
    """Bounds that cut common words, pairs and whole sequences leave the counts as they are."""
    rows = word_rows(partitions, 300)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5).withColumn("range", F.lit("clash")).withColumn("f", F.lit(1))
    monkeypatch.setattr(collocations, "RANGE_WORDS", 700)
    bounds = collocations._sample_bounds(docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")), partitions)
    assert len(bounds) > 10
    assert spark_collocations(docs, min_count=3, top=40, partitions=partitions) == plain_collocations(rows, 3, 40)


def test_collocations_ties(spark):
    """Equal scores and counts are ordered by the phrase's bytes; rows at the cut are not lost."""
    rows = [("en", f"{a} {b}.") for a, b in [("zz", "é"), ("zz9", "a"), ("b", "c"), ("Ä", "d"), ("b2", "c2")] for _ in range(30)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert spark_collocations(docs, top=3) == plain_collocations(rows, 30, 3)


def test_collocations_large_counts(spark):
    """Scores are exact where products pass 64 bits."""
    a, both = 6_000_000_000_007, 6_000_000_000_007 * 2 + 11
    got = spark.sql(f"select cast(cast({collocations.SCALE} as decimal(20, 0)) * cast({a}L as decimal(18, 0)) div cast({both}L as decimal(18, 0)) as bigint)").first()[0]
    assert got == 2_000_000 * a // both


def test_collocations_empty(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, " . ")], "lang string, text string")).count() == 0


sequences = st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=6), min_size=1, max_size=12)


@settings(max_examples=100, deadline=None)
@given(sequences, sequences, st.lists(st.integers(0, 5), min_size=4, max_size=4))
def test_automata(left, right, bound):
    """Blocks keep paths and weights, united automata hold the sums, lookups agree with counts."""
    both = []
    want = Counter()
    for pieces in (left, right):
        symbols = np.array([s for p in pieces for s in p], np.uint64)
        piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        vocab, ids, counts = ca.sorted_paths(symbols, piece)
        for p in pieces:
            for i in range(len(p)):
                for size in range(1, min(4, len(p) - i) + 1):
                    want[tuple(p[i : i + size])] += 1
        bound = [b for b in bound if b] + [0] * (4 - len([b for b in bound if b]))
        at = ca.place_of(vocab, ids, tuple(bound))
        names = [tuple(int(vocab[x - 1]) if x else 0 for x in row) for row in ids]
        assert names == sorted(names) and at == sum(x < tuple(bound) for x in names)
        for lo, hi in ((0, at), (at, len(ids))):
            if lo < hi:
                back = ca.decode_block(ca.encode_block(vocab, ids[lo:hi], counts[lo:hi]))
                assert [tuple(int(back[0][x - 1]) if x else 0 for x in row) for row in back[1]] == names[lo:hi]
                assert back[2].tolist() == counts[lo:hi].tolist()
                both.append(back)
    vocab, ids, counts = ca.unite(both)
    keys, weights = [], []
    for level in range(1, 5):
        first, weight = ca.states(ids, counts, level)
        for i, w in zip(first, weight, strict=True):
            key = [int(vocab[x - 1]) for x in ids[i, :level]]
            assert want[tuple(key)] == w
            keys.append(key + [0] * (4 - level))
            weights.append(w)
    assert len(keys) == len(want)
    table = ca.Lookup(np.array(keys, np.uint64), np.array(weights, np.int64))
    asked = [list(k) + [0] * (4 - len(k)) for k in want] + [[9, 0, 0, 0], [1, 9, 1, 1], bound]
    assert table.find(np.array(asked, np.uint64)).tolist() == [want.get(tuple(x for x in a if x), 0) for a in asked]


def test_heavy_weights():
    vocab = np.array([5, 7], np.uint64)
    ids = np.array([[1, 0, 0, 0], [1, 2, 0, 0], [2, 2, 2, 2]], np.uint32)
    counts = np.array([254, 255, 1 << 40])
    back = ca.decode_block(ca.encode_block(vocab, ids, counts))
    assert back[1].tolist() == ids.tolist() and back[2].tolist() == counts.tolist()
