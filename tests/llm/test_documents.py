"""Document operators against brute force, on sf0.001 and on odd tables."""

import hashlib
import random

import plain_versions as brute
import pytest
from tables import make_docs, sf_table, shared_code  # noqa: F401 - fixtures
from pyspark.sql import functions as F

import __spark_entry__ as E
from farelane.llm import bpe, decontaminate, line_dedup, near_dup, pii, quality, token_counts
from farelane.llm.paths import tokenizer_path


SF_SMALL = "/root/testdata/sf0.001"


def texts_of(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(n))


ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one two"),
    (5, "One TWO"),
    (6, prose(1, 400)),
    (7, prose(1, 400) + " extra"),
    (8, prose(2, 30) + "\n" + prose(2, 30)),
    (9, "日本語 テキスト 😀 " * 12),
    (10, prose(3, 60)),
    (11, prose(3, 60)),
    (None, prose(3, 60)),
    (12, "a" * 300_000),
    (13, prose(4, 30_000)),
]


def test_quality_counts(spark):
    docs = texts_of(spark)
    got = {r["doc_id"]: r for r in E.queries()["op10_quality_rules"](spark, SF_SMALL).collect()}
    for d, t in docs:
        n, chars, symbols, dup, repeat = brute.quality_counts(t)
        r = got[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        assert not (r["base_failed"] and r["kept"])


def test_quality_agrees_with_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = E.queries()["op10_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").filter("n_words >= 10")
    good = judged.filter("quality = 1").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    junk = judged.filter("quality = 0").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good > 0.98 and junk < 0.05


def test_quality_lines(make_docs):
    clean = "A plain sentence that says something useful to its readers.\n" * 1 + prose(5, 60) + "."
    junk = clean + "\n" + "Home | News | Sport | Weather | Login | Help" + "\n" + "All rights reserved."
    spam = "BUY NOW!! CHEAP!! PILLS!! HERE!! TODAY!! ONLY!! FOR!! YOU!! AND!! ME!! FRIENDS!!"
    rows = {r["doc_id"]: r["text"] for r in quality.filter_documents(make_docs([(1, clean), (2, junk), (3, spam), *[(100 + i, t) for i, t in ODD[:5]]])).collect()}
    assert rows == {1: clean, 2: clean}


def test_quality_open_ends(make_docs):
    """The end of a long line is judged, by whole characters."""
    latin = " ".join(f"word{i}" for i in range(45))
    russian = " ".join(f"слово{i}с" for i in range(45))
    greek = " ".join(f"λόγος{i}ς" for i in range(45))
    cut = [latin, latin.replace("word9", "word9,"), latin + ",", russian, greek, " ".join(f"文字{i}中" for i in range(45))]
    whole = [f"{t}{end}" for t in (latin, russian) for end in (".", "…", "。", "»", "”", "!  ", ".)")] + [" ".join(f"คำ{i}ก" for i in range(45)), "A Heading Without An End", "- a list entry"]
    rows = {r["doc_id"]: r["n_failed_lines"] for r in quality.judge(make_docs(list(enumerate(cut + whole)))).collect()}
    assert [rows[i] for i in range(len(cut + whole))] == [1] * len(cut) + [0] * len(whole)


@pytest.mark.parametrize("name", ["kept", "n_words", "text2"])
def test_quality_odd_tables(make_docs, name):
    docs = make_docs(ODD).withColumn(name, F.lit("mine"))
    out = quality.judge(docs)
    assert out.count() == len(ODD)
    assert quality.filter_documents(docs).columns == docs.columns
    assert quality.judge(docs.limit(0)).count() == 0


def test_bpe_matches_library(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    for r in E.queries()["op7_bpe"](spark, SF_SMALL).join(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id").collect():
        ids = own.encode(r["text"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == sha(own.decode(ids, skip_special_tokens=False))


def test_bpe_fuzz(make_docs):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path())
    r = random.Random(7)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "a", "Z", "7", "é", "日", " ", "　", "\x1c", "\x85", "!", "»", "<|endoftext|>", "<|", "😀", "\r", "_", "́"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 25)))) for i in range(3000)] + [(5000 + i, t) for i, (_, t) in enumerate(ODD)]
    coded = bpe.decode(bpe.encode(make_docs(rows), tokenizer_path()), tokenizer_path())
    for x in coded.collect():
        ids = own.encode(x["text"] or "", add_special_tokens=False).ids
        assert x["ids"] == b"".join(i.to_bytes(4, "little") for i in ids), repr(x["text"])
        assert x["decoded"] == (x["text"] or "") and x["n_tokens"] == len(ids)


def test_token_counts(spark, make_docs):
    rows = {r["length"]: r for r in E.queries()["op8_token_counts"](spark, SF_SMALL).collect()}
    lengths = [r["n_tokens"] for r in E.queries()["op7_bpe"](spark, SF_SMALL).collect()]
    assert set(rows) == set(lengths)
    for limit, r in rows.items():
        assert r["n_docs"] == lengths.count(limit)
        assert r["docs_longer"] == sum(x > limit for x in lengths)
        assert r["tokens_at_most"] == sum(x for x in lengths if x <= limit)
        assert r["truncated_tokens"] == sum(min(x, limit) for x in lengths)
    h = token_counts.length_histogram(token_counts.token_lengths(make_docs(ODD), tokenizer_path()))
    assert h.agg(F.sum("n_docs")).first()[0] == len(ODD)
    report = {r["limit"]: r for r in token_counts.limit_report(h, [10, 1000]).collect()}
    assert report[10]["n_docs"] == len(ODD) and report[10]["tokens"] <= 10 * len(ODD)
    assert token_counts.quantiles(token_counts.context_totals(h), [0.5]).count() == 1
    assert token_counts.context_totals(h.limit(0)).count() == 0


def test_decontamination(spark, make_docs, sf_table):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    docs = texts_of(spark)
    want = brute.contaminated(docs, items)
    for r in E.queries()["op1_decontaminate"](spark, SF_SMALL).collect():
        n, hit, found, bad = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), bad)
        assert r["items_sha256"] == sha(",".join(found))


def test_decontamination_odd(spark, make_docs):
    items = [(1, None), (2, ""), (3, "beta gamma"), (4, prose(3, 60)), (4, "kappa"), (None, prose(4, 20)), (11, prose(9, 40))]
    docs = [*ODD, (20, "x BETA, gamma beta--gamma"), (21, "kappa"), (22, prose(9, 13)), (23, prose(9, 12))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(1)).withColumn("hash", F.lit("x"))
    table = make_docs(docs).withColumn("key", F.lit(5)).withColumn("doc", F.lit("d"))
    got = decontaminate.contamination(table, bench)
    assert got.columns[:7] == table.columns and got.count() == len(docs)
    want = brute.contaminated([(d, t) for d, t in docs if d is not None], [("" if i is None else i, t) for i, t in items])
    for r in got.filter("doc_id is not null").collect():
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == want[r["doc_id"]], r["doc_id"]
    kept = decontaminate.drop_contaminated(table, bench)
    assert kept.columns == table.columns
    assert decontaminate.contamination(table.limit(0), bench).count() == 0
    assert decontaminate.contamination(table, bench.limit(0)).filter("contaminated").count() == 0


def test_near_duplicates(spark):
    want = brute.near_components(texts_of(spark))
    got = {r["doc_id"]: r for r in E.queries()["op4_near_dup"](spark, SF_SMALL).collect()}
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == want
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


def test_near_duplicates_odd(make_docs):
    r = random.Random(3)
    base = prose(11, 120).split()
    chain = []
    for i in range(40):  # a chain of small edits, each similar to the one before
        base = list(base)
        base[r.randrange(len(base))] = f"edit{i}"
        chain.append((200 + i, " ".join(base)))
    docs = [*ODD, *chain]
    table = make_docs(docs).withColumn("n", F.lit("x")).withColumn("sig", F.lit(1))
    want = brute.near_components([(d, t) for d, t in docs if d is not None])
    rows = near_dup.components(table).collect()
    assert len(rows) == len(docs)
    assert {x["id"]: (x["n_shingles"], x["component_id"]) for x in rows if x["id"] is not None} == want
    kept = near_dup.keep_first(table)
    assert kept.columns == table.columns
    assert {x["doc_id"] for x in kept.collect()} == {d for d, (_, c) in want.items() if c == d} | {None}
    assert near_dup.components(table.limit(0)).count() == 0


def test_near_duplicates_every_member_of_a_dense_node(spark):
    """A member outside the largest component meets all members that may be similar, not only those whose signatures agree most."""
    def sig(agree):
        return bytearray(b"".join((i if i < agree else 1000 + agree).to_bytes(4, "little") for i in range(near_dup.TOKENS)))

    agree = {0: near_dup.TOKENS, 7: 36, 8: 20, **{10 + i: 40 for i in range(40)}}  # 7 is the true partner, 8 is unlike
    reps = spark.createDataFrame([(i, 100 if i != 15 else 200, sig(n)) for i, n in agree.items()], "id long, n long, sig binary")
    component = {i: 0 if i == 0 else 7 for i in agree}
    opened = spark.createDataFrame([(1, i, c, 7, 1, len(agree)) for i, c in component.items()], "node long, id long, component long, major long, rest long, all long")
    pairs = {(r["a"], r["b"]) for r in near_dup._facing(opened, reps, near_dup.THRESHOLD).collect()}
    assert pairs == {(0, i) for i in agree if i not in (0, 8, 15)}


def test_lines(spark):
    want = brute.repeated_lines(texts_of(spark))
    got = E.queries()["op9_line_dedup"](spark, SF_SMALL).collect()
    assert {(r["doc_id"], int(x)) for r in got for x in r["removed"].split(",") if x} == want


def test_lines_odd(make_docs):
    line = "The quick brown fox jumps over the lazy dog near the river bank"
    many = [(300 + i, f"{line} {i}\nshort\n{prose(40 + i, 20)}") for i in range(30)]
    docs = [(1, None), (2, ""), (3, line), (4, f"  {line} \nother text that is unique to this document"), (5, line.upper()), *many, (None, line)]
    table = make_docs(docs).withColumn("key", F.lit(1)).withColumn("at", F.lit(2))
    report = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(table).collect()}
    assert len(report) == len(docs)
    want = brute.repeated_lines([(-1 if d is None else d, t) for d, t in docs])
    assert {(-1 if d is None else d, x) for d, v in report.items() for x in v} == want
    kept = line_dedup.drop_repeated_lines(table)
    assert kept.columns == table.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[1] is None and texts[2] == "" and 5 not in texts and texts[300].startswith("short\n")
    assert line_dedup.line_report(table.limit(0)).count() == 0


def test_personal_data(spark, make_docs):
    for r in E.queries()["op2_pii"](spark, SF_SMALL).join(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), "doc_id").collect():
        assert r["base_sha256"] == sha(",".join(brute.personal(r["text"])))
    odd = [
        "a.b@c.de_f@g.hi 1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255 256.1.1.1",
        "😀😀 x@y.z 😀 +1 (487) 555-7209 4111 1111 1111 1111 4111-1111-1111-1112 ++12 +1234567890",
        "@@ a@b a@b. a@.c %@-.- " + "7" * 5000 + " 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5",
        "a" * 200_000,
        "1." * 50_000,
        "+1-2" * 30_000,
        "",
        None,
    ]
    r = random.Random(2)
    odd += ["".join(r.choice("0123456789.@+-() ab😀") for _ in range(r.randint(0, 60))) for _ in range(2000)]
    table = make_docs(list(enumerate(odd))).withColumn("rid", F.lit(1)).withColumn("candidate", F.lit("x"))
    got = {x["doc_id"]: x for x in pii.report(table).collect()}
    assert len(got) == len(odd)
    for i, t in enumerate(odd):
        want = brute.personal(t)
        assert got[i]["base"] == ",".join(want), repr(t)[:100]
        assert set(want) <= set(got[i]["spans"].split(",")) | {""}
    assert pii.report(table.limit(0)).count() == 0


def test_personal_data_bootstrap(make_docs):
    r = random.Random(9)
    rows = [(i, f"{prose(100 + i, 8)} please call me at +1 487 555 {1000 + i} or later {prose(500 + i, 8)}") for i in range(40)]
    rows += [(100 + i, f"{prose(900 + i, 8)} please call me at (487) 555-{2000 + i} or later") for i in range(5)]
    rows += [(200 + i, f"the order number {r.randint(10**7, 10**8)} was shipped on day {i}") for i in range(20)]
    got = {x["doc_id"]: x for x in pii.report(make_docs(rows)).collect()}
    assert all(got[i]["n_added"] == 0 for i in [*range(40), *range(200, 220)])
    assert all(got[100 + i]["n_added"] == 1 and got[100 + i]["spans"].startswith("phone:") for i in range(5))


def added_spans(table, texts, **options):
    """id -> the added spans' (kind, text)."""
    got = {}
    for r in pii.report(table, **options).collect():
        base = set(r["base"].split(",")) if r["base"] else set()
        for x in r["spans"].split(",") if r["spans"] else []:
            if x not in base:
                kind, start, end = x.split(":")
                got.setdefault(r["doc_id"], set()).add((kind, texts[r["doc_id"]][int(start) : int(end)]))
    return got


def test_personal_data_half_unseen(make_docs):
    """A context is trusted when half of its identifiers are unseen, and not when most are of an impossible shape or another kind."""
    texts = {i: f"please phone +49 30 55{i:06d} today" for i in range(60)}
    texts |= {100 + i: f"please phone 030 66{i:06d} today" for i in range(60)}
    texts |= {200 + i: f"on the date +49 40 77{i:06d} we met" for i in range(20)}
    texts |= {300 + i: f"on the date 2024-{1 + i % 12:02d}-{10 + i % 18} we met" for i in range(60)}
    texts |= {400 + i: f"order number 88{i:07d} was sent" for i in range(60)}
    got = added_spans(make_docs(list(texts.items())), texts)
    assert {i: got.get(i) for i in range(100, 160)} == {i: {("phone", texts[i][13:-6])} for i in range(100, 160)}
    assert set(got) == set(range(100, 160))


def test_personal_data_second_round(make_docs):
    """A context without any seed is reached through the instances found in the first round."""
    texts = {i: f"please phone +49 30 55{i:06d} today" for i in range(60)}
    texts |= {100 + i: f"please phone 030 66{i:06d} today" for i in range(30)}
    texts |= {200 + i: f"her extension 030 66{i:06d} rings" for i in range(30)}  # the same numbers
    texts |= {300 + i: f"her extension 040 99{i:06d} rings" for i in range(20)}  # new ones
    table = make_docs(list(texts.items()))
    one, three = added_spans(table, texts, rounds=1), added_spans(table, texts, rounds=3)
    assert set(range(100, 130)) <= set(one) and not set(range(300, 320)) & set(one)
    assert set(range(300, 320)) <= set(three)


def test_quality_menus(make_docs):
    """Menus and word lists fail, headings, short lists and clean prose stay."""
    r = random.Random(5)
    words = prose(3, 400).replace(".", "").replace(",", "").lower().split()
    clean = "\n".join(f"{prose(i, 18).rstrip('.')}." for i in range(8))
    bad = {
        1: "\n".join(w.title() for w in words[:12]),
        2: " · ".join(w.title() for w in words[:12]),
        3: " › ".join(" ".join(words[3 * i : 3 * i + 3]).title() for i in range(16)),
        4: "\n".join(" ".join(r.choice(words) for _ in range(30)) for _ in range(20)),
    }
    good = {
        11: clean,
        12: "The Heading\n" + clean + "\nOne\nTwo\nThree",
        13: clean + "\n" + "Это длинная строка без точки " * 2,
        14: clean.replace(" ", " - ", 1),
    }
    got = {x["doc_id"]: x for x in quality.judge(make_docs([*bad.items(), *good.items()])).collect()}
    assert [i for i in bad if got[i]["kept"]] == []
    assert [i for i in good if not got[i]["kept"] or got[i]["n_failed_lines"]] == []
