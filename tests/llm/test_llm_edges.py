"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from panelmill.llm import arc, neighbours, ordinal, packing, paragraphs, pieces, quality, simhash, token_counts, token_store
from panelmill.llm.contract import BYTE, PIECE, WORD

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, fp string, "
    "words string, kept string, component string"
)


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(n))


PASSAGE = prose(1, 60)
ROWS = [
    (1, PASSAGE + "\n" + prose(2, 30), "en", "a"),
    (2, PASSAGE + "\n" + prose(2, 30), "en", "a"),  # a copy
    (2, PASSAGE + "\n" + prose(2, 30), "en", "a"),  # a repeated row
    (3, None, None, None),
    (4, "", "en", None),
    (None, prose(3, 40), None, "a"),
    (None, None, "en", "a"),
    (5, " \n\t \n", "en", "a"),
    (6, prose(4, 20_000), "de", "b"),
    (7, "x " * 3000, "de", "b"),
    (8, "Ünïcödé ▁ 日本 <|endoftext|> 　 é don't  stop\r\n", "de", "b"),
    (9, prose(5, 25) + "\n" + PASSAGE, "de", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, *["x"] * 6) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (2, 1, 1), (7, 0, 0), (None, 1, 0), (9, None, 0), (99, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def keys(rows):
    return sorted((r[0] for r in rows), key=str)


ALL_KEYS = sorted((r[0] for r in ROWS), key=str)


def test_quality(docs, nothing):
    got = quality.quality_rules(docs).collect()
    assert keys(got) == ALL_KEYS
    by = {r.doc_id: r for r in got}
    assert by[3].n_words == 0 and by[3].base_failed and not by[3].kept
    assert by[7].n_words == by[7].n_repeat_words == 3000 and by[7].base_failed
    assert by[6].n_words == 20_000 and not by[6].base_failed
    assert quality.quality_rules(nothing).collect() == []
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert keys(kept.collect()) == keys(r for r in got if r.kept)


def test_simhash(docs, nothing):
    got = simhash.near_duplicates(docs).collect()
    assert keys(got) == ALL_KEYS
    by = {r.doc_id: r for r in got}
    assert by[1].component_id == by[2].component_id == 1
    assert {by[3].fingerprint, by[4].fingerprint, by[5].fingerprint} == {"0" * 16}
    assert by[5].component_id == by[4].component_id == 3 == by[None].component_id or by[None].fingerprint != "0" * 16
    assert simhash.near_duplicates(nothing).collect() == []
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns
    assert [k for k in keys(one.collect()) if k in (1, 2, 3, 4, 5)] == [1, 3]


def test_simhash_tiles(spark):
    draw = random.Random(0)
    base = draw.getrandbits(63)
    prints = {base}
    for _ in range(150):
        x = base
        for _ in range(draw.randint(0, 5)):
            x ^= 1 << draw.randrange(63)
        prints.add(x)
    rows = sorted(prints)
    df = spark.createDataFrame([(x,) for x in rows], "fp bigint")
    edges = [tuple(r) for r in simhash.linked(df, 4, tile=16).collect()]
    joined = {x: x for x in rows}

    def root(sets, x):
        while sets[x] != x:
            x = sets[x]
        return x

    want = dict(joined)
    for sets, pairs in ((joined, edges), (want, [(a, b) for a in rows for b in rows if (a ^ b).bit_count() <= 4])):
        for a, b in pairs:
            a, b = root(sets, a), root(sets, b)
            sets[max(a, b)] = min(a, b)
    assert {x: root(joined, x) for x in rows} == {x: root(want, x) for x in rows}
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)


def test_simhash_forest_tests_waiting_fingerprints():
    """One large bucket with two centres: links between what different askers have reached."""
    import numpy as np

    for seed in range(40):
        draw = random.Random(seed)
        a = draw.getrandbits(64)
        b = a ^ 0xFF
        prints = {a, b, a ^ 0b111, a ^ 0b1111111}  # only the last two link the centres
        while len(prints) < 300:
            high = sum(1 << bit for bit in draw.sample(range(8, 64), draw.randint(1, 3)))
            prints.add(draw.choice([a, b]) ^ high)
        prints = sorted(prints)
        draw.shuffle(prints)
        prints = np.array(prints, np.uint64)
        apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
        groups = []
        number = {int(p): i for i, p in enumerate(prints)}
        found = simhash.forest(prints, 4)
        for pairs in (np.argwhere(apart <= 4).tolist(), [(number[x], number[y]) for x, y in found]):
            group = np.arange(len(prints))
            for i, j in pairs:
                group[group == max(group[i], group[j])] = min(group[i], group[j])
            groups.append(group.tolist())
        assert groups[0] == groups[1]
        assert all((x ^ y).bit_count() <= 4 for x, y in found)


def test_passages(docs, nothing):
    got = paragraphs.repeated_passages(docs).collect()
    assert {(r.doc_id, r.paragraph, r.removed) for r in got} == {(1, 0, False), (2, 0, True), (9, 1, True)}
    assert {r.first_doc_id for r in got} == {1} and {r.cluster_size for r in got} == {4}
    assert paragraphs.repeated_passages(nothing).collect() == []
    cut = paragraphs.without_repeats(docs)
    assert cut.columns == docs.columns
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[1] == ROWS[0][1] and PASSAGE not in texts[2] and texts[9] == prose(5, 25)
    assert texts[3] is None and texts[4] == ""


def test_one_occurrence_of_a_passage_stays(spark):
    """Also among repeated rows of one key and among rows without a key."""
    lines = {7: PASSAGE, None: prose(60, 60)}
    rows = [(k, f"{line}\n{tail}") for k, line in lines.items() for tail in ("a", "b", "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    got = paragraphs.repeated_passages(df).collect()
    texts = [r.text for r in paragraphs.without_repeats(df).collect()]
    assert len(texts) == 6
    for k, line in lines.items():
        assert sorted(r.removed for r in got if r.doc_id == k) == [False, True, True]
        assert sum(line in x for x in texts) == 1


def test_passages_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(paragraphs, "TILE", 3)
    words = PASSAGE.split()
    near = [" ".join([*words[:i], "zz", *words[i + 1:]]) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(near)), "doc_id bigint, text string")
    got = paragraphs.repeated_passages(df).collect()
    assert len(got) == 20 and {r.first_doc_id for r in got} == {0}


def test_bands():
    bands, rows = paragraphs.tuned_bands(0.8, 0.9995, 64)
    assert bands * rows <= 64 and 1 - (1 - 0.8**rows) ** bands >= 0.9995


def test_token_counts(docs, nothing, spark, tmp_path):
    cache = f"file://{tmp_path}/cache"
    first = {tuple(r) for r in token_counts.token_counts(docs, "piece", PIECE, cache).collect()}
    stored = spark.read.parquet(cache).count()
    assert stored == len({r[1] or "" for r in ROWS})
    assert {tuple(r) for r in token_counts.token_counts(docs, "piece", PIECE, cache).collect()} == first
    assert spark.read.parquet(cache).count() == stored  # nothing was missing
    by = {r[0]: r for r in first}
    assert by[4] == (4, 0, 0, False) and by[6][3]
    assert token_counts.token_counts(nothing, "piece", PIECE).collect() == []
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert all(by[k][2] == len(model.encode(t or "")) for k, t, *_ in ROWS if k is not None)


def test_pieces(docs, nothing):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = pieces.encode_decode(docs, PIECE).collect()
    want = [(k, model.encode(t or ""), model.decode(model.encode(t or ""))) for k, t, *_ in ROWS]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert pieces.encode_decode(nothing, PIECE).collect() == []


def test_token_store(docs, nothing, spark, tmp_path):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BYTE)
    manifest = token_store.write_store(docs, f"file://{tmp_path}", BYTE, shard_tokens=1000)
    got = sorted(token_store.read_store(manifest).collect(), key=lambda r: r.start)
    assert [r.key for r in got] == [None, None, 1, 2, 2, 3, 4, 5, 6, 7, 8, 9]
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    import numpy as np

    ids = {r.key: np.frombuffer(r.ids, "<u4").tolist() for r in got}
    texts = {r[0]: r[1] for r in ROWS}
    assert all(ids[k] == [*model.encode(texts[k] or "", add_special_tokens=False).ids, 2] for k in range(1, 10))
    asked = spark.createDataFrame([(2,), (9,), (9,), (77,), (None,)], "doc_id bigint")
    found = token_store.fetch(spark, manifest, asked).collect()
    assert keys(found) == [2, 2, 9]
    assert token_store.read_store(token_store.write_store(nothing, f"file://{tmp_path}", BYTE)).collect() == []


def test_perfect_hash():
    import numpy as np

    names = np.random.default_rng(0).integers(-(2**62), 2**62, 20_000)
    names = np.unique(names)
    slots = token_store.PerfectHash.build(names).slots(names)
    assert sorted(slots.tolist()) == list(range(len(names)))


def test_packing(docs, nothing):
    got = packing.pack(docs, WORD).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    long = sorted((r.start, r.length) for r in got if r.doc_id == 6)
    assert len(long) > 2 and all(a + n == b for (a, n), (b, _) in zip(long, long[1:], strict=False))
    assert [r.length for r in got if r.doc_id in (3, 4)] == [1, 1]
    assert packing.pack(nothing, WORD).collect() == []


def test_windows():
    draw = random.Random(3)
    for _ in range(50):
        items = [draw.randint(1, 100) for _ in range(draw.randint(0, 60))]
        parts = packing.windows(items, 100)
        assert sorted(i for p in parts for i in p) == list(range(len(items)))
        assert all(sum(items[i] for i in p) <= 100 for p in parts)
        assert len(parts) <= -(-sum(items) // 100) * 1.5 + 1


def test_classifier(docs, nothing, labels):
    got = ordinal.classify(docs, labels).collect()
    assert keys(got) == ALL_KEYS
    assert all(0 <= r.tail_probability <= r.expected_grade <= 2 for r in got)
    assert ordinal.classify(nothing, labels).collect() == []
    assert len(ordinal.classify(docs, labels.where("false")).collect()) == len(ROWS)
    assert ordinal.keep_best(docs, docs, labels, keep=0.0).columns == docs.columns


def test_archives(spark, tmp_path):
    big = "é" * 600
    rows = [
        (1, "http://a.example/x y\nz", big), (2, "http://b.example/", big), (3, None, big), (4, "http://c.example/", None),
        (5, "http://d.example/", "same"), (6, "http://e.example/", "same"), (None, "http://f.example/", "a\r\n\r\nb"),
        (7, "http://g.example/", "HTTP/1.0 WARC/1.0\r\n\r\n"), (8, "http://h.example/", "z" * 3_000_000),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, key int").repartition(2)
    arcs = arc.write_arc(pages, f"file://{tmp_path}")
    assert {r.version for r in _versions(arcs)} == {1, 2}
    warcs = arc.convert(arcs, f"file://{tmp_path}")
    got = {r.key: r for r in arc.with_referred_keys(arc.read_warc(warcs)).collect()}
    assert got[1].refers_to == got[2].refers_to == 3 and got[1].record_type == "revisit"
    assert got[3].record_type == got[5].record_type == got[6].record_type == "response"
    for key, _, html in rows:
        data = (html or "").encode()
        assert (got[key].payload_bytes, got[key].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())  # noqa: S324
    again = arc.convert(arcs, f"file://{tmp_path}")
    assert {r.record_id for r in arc.read_warc(again).collect()} == {r.record_id for r in got.values()}
    none = arc.write_arc(pages.where("false"), f"file://{tmp_path}")
    assert arc.read_warc(arc.convert(none, f"file://{tmp_path}")).collect() == []


def _versions(arcs):
    from panelmill.llm.shared import file_system

    found = []
    for r in arcs.collect():
        system, inner = file_system(r.path)
        with system.open_input_stream(inner, compression=None) as file:
            found += list(arc.arc_records(file))
    return found


def test_archive_lines():
    import io

    one = b"filedesc://x 0.0.0.0 20010101000000 text/plain 77\n1 0 me\nURL IP-address Archive-date Content-type Archive-length\n"
    one = one.replace(b" 77\n", b" %d\n" % len(one.split(b"\n", 1)[1])) + b"\ndns:a 1.2.3.4 200102030405 text/dns 3\nabc\n"
    (record,) = arc.arc_records(io.BytesIO(one))
    assert (record.url, record.payload, arc.warc_type(record)) == ("dns:a", b"abc", "response")
    assert arc.warc_date("200102030405") == "2001-02-03T04:05:00Z" and arc.warc_date("x") == "1970-01-01T00:00:00Z"
    with pytest.raises(ValueError, match="declares"):
        list(arc.arc_records(io.BytesIO(one[:-3])))


def test_neighbours(spark):
    import numpy as np

    draw = np.random.default_rng(5)
    centres = draw.normal(size=(8, 12))
    vectors = centres[draw.integers(0, 8, 600)] + 0.2 * draw.normal(size=(600, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(600 + i, rows[50][1]) for i in range(40)]  # equal vectors
    bad = [(700, None), (701, [0.0] * 12), (702, [None] + [1.0] * 11), (703, [float("nan")] * 12), (704, [1.0]), (None, [1.0] * 12)]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id bigint, embedding array<double>, vector int")
    got = {}
    for r in neighbours.search(df, df.where("vec_id % 50 = 0"), block=64).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert sorted(got) == list(range(0, 650, 50))
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    hits = 0
    for q, found in got.items():
        s = np.round(u @ u[ids == q][0], 12)
        s[ids == q] = -9
        best = ids[np.lexsort((ids, -s))[:5]].tolist()
        hits += len({v for v, _ in found.values()} & set(best))
        assert sorted(found) == [1, 2, 3, 4, 5] and q not in [v for v, _ in found.values()]
    assert hits >= 0.9 * 5 * len(got)
    assert [got[50][i][0] for i in range(1, 6)] == [600, 601, 602, 603, 604]
    assert neighbours.search(df.where("false"), df.where("false")).collect() == []
    few = df.where("vec_id < 3")
    assert neighbours.search(few, few.where("vec_id % 50 = 0")).count() == 2


def test_neighbours_of_several_lengths(spark):
    import numpy as np

    draw = np.random.default_rng(6)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, draw.normal(size=3).tolist()) for i in range(20)] + [(200, [1.0] * 9)]  # one longer than all
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asked = df.where("vec_id IN (0, 100, 200)")
    got = {}
    for r in neighbours.search(df, asked, block=8, recall=1.0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert sorted(got) == [0, 100]  # nothing has the length of 200
    by = dict(rows)
    for q, found in got.items():
        same = [i for i, v in rows if len(v) == len(by[q]) and i != q]
        score = lambda i: float(neighbours.cosine(np.array(by[q]), np.array(by[i])))  # noqa: E731, B023
        assert [found[r] for r in range(1, 6)] == sorted(same, key=lambda i: (-score(i), i))[:5]


def test_neighbours_ties(spark):
    """Many parallel vectors of different lengths tie exactly; the smallest keys win."""
    base = [1.0, 2.0, -3.0, 0.5]
    rows = [(1000, base)] + [(999 - j, [x * 2.0 ** (j - 150) for x in base]) for j in range(300) if j != 150]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.search(df, df.where("vec_id = 1000")).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [700, 701, 702, 703, 704]


def test_components(spark):
    from panelmill.llm.components import components

    chain = [(i, i + 1) for i in range(100)] + [(200, 150), (150, 200), (7, 7), (None, 3)]
    df = spark.createDataFrame(chain, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(101)}, 150: 150, 200: 150}
    assert components(df.where("false")).collect() == []


def test_look_up_hot_keys(spark):
    from panelmill.llm.skew import look_up

    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id")).alias("k"))
    table = spark.createDataFrame([(1, "hot"), (4, "cold")], "k bigint, v string")
    got = look_up(rows, table, "k").groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {"hot": 1667 + (1 if 5000 % 3 == 9 else 0), "cold": 1, None: 5000 - 1668}


def test_quality_limits_follow_the_group(spark):
    """Each rule rejects a document that passes the base rules, and two groups get different limits."""
    rows = []

    def add(group, text):
        rows.append((len(rows), text, "en", group))

    for i in range(420):
        add("plain", prose(1000 + i, 60))
        add("code", " ".join(w + (" #" if j % (2 + i % 3) == 0 else "") for j, w in enumerate(prose(3000 + i, 60).split())))
    odd = {
        "n_symbols": prose(5000, 60).replace(" ", " # ", 25),
        "n_dup_lines": "\n".join(["one two", prose(5001, 60), *["one two"] * 8]),
        "n_repeat_words": prose(5002, 60) + " " + " ".join([prose(5003, 9)] * 2),
        "word_chars": " ".join(w * 6 for w in prose(5004, 60).split()),
    }
    first = len(rows)
    for text in odd.values():
        add("plain", text)
    add("code", odd["n_symbols"])  # usual there
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    for i, figure in enumerate(odd):
        assert not got[first + i].base_failed and not got[first + i].kept, figure
    assert got[first + 4].kept and sum(not r.kept for r in got.values()) <= 10
    limits = quality.thresholds(quality.measured(docs, "doc_id", "text", "lang", "source")).collect()
    assert len({r.most_symbols_permille for r in limits}) == 2


@pytest.mark.parametrize("share", [0.9, 0.0])
def test_look_up_leaves_null_keys_where_they_are(spark, share):
    """Most keys null, one key hot: the join's rows are those of a plain join, and no partition takes the nulls in."""
    from panelmill.llm.skew import look_up

    rows = spark.range(0, 20_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 100 >= share * 100, F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))).alias("k"))
    table = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = look_up(rows, table, "k")
    want = rows.join(table, "k", "left")
    assert sorted(got.columns) == ["id", "k", "v"]
    assert got.select("id", "k", "v").exceptAll(want.select("id", "k", "v")).isEmpty() and got.count() == 20_000
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert share == 0.0 or max(sizes) <= 20_000 / 7


def test_no_collection_while_a_block_is_coded(monkeypatch):
    """The collector rests during a block and runs again after it, also after a failure."""
    import gc

    import pyarrow as pa

    from panelmill.llm import chunks

    code, seen = chunks.ChunkCoder("word", WORD), []
    block = code._block
    monkeypatch.setattr(code, "_block", lambda texts: (seen.append(gc.isenabled()), block(texts))[1])
    ids, begins = code.encode(pa.array(["one two", None, "three"]))
    assert seen == [False] and gc.isenabled() and begins.tolist()[-1] == len(ids)
    monkeypatch.setattr(code, "_block", lambda texts: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        code.encode(pa.array(["one"]))
    assert gc.isenabled()
