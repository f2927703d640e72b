import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
from telemetra.llm import decontam, licenses, lm_score, mixing, neardup, pu_quality, quality_rules, sharding, url_filter, warc
from telemetra.llm.chunked import unpack
from telemetra.session import work_dir
from tests.test_entry import SF, _rows, con  # noqa: F401

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string"
BASE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from their old oak tree and say nothing at all"
ODD = [
    (1, None, "en", "a", 0, "x", "y"),
    (2, "", "en", None, 0, "x", "y"),
    (None, "one two three four five six seven eight nine ten", None, "a", 1, "x", "y"),
    (3, BASE, "en", "b", 1, "x", "y"),
    (3, BASE, "en", "b", 1, "x", "y"),
    (4, BASE.replace("nothing", "something"), "en", "b", 1, "x", "y"),
    (5, "lone", "en", "c", 1, "x", "y"),
    (6, "Released UNDER the MIT-License. " + "w " * 30_000 + "cc by nc\n\ncc by nc", "en", "c", 1, "x", "y"),
    (7, "Ça va? Été\n" + "- a b c d e f\n" * 4 + "#*$%", "fr", "b", 1, "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, 0) for k in range(8)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", ["op1_mixing", "op3_licenses", "op6_sharding", "op8_warc", "op9_url_filters"])
def test_query_matches_sql(spark, con, name):  # noqa: F811
    got, want = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_mixing_odd_rows(odd, spark):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD)
    by = {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for own in by.values():
        assert sum(r.taken for r in own) == math.floor(own[0].target) and own[0].target <= 2 * own[0].source_size
    assert mixing.emit(odd).columns == odd.columns
    assert mixing.mix(odd.limit(0)).count() == 0


def test_sharding_odd_rows(odd):
    rows = sharding.shard(odd, n_shards=3).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert sharding.shard(odd.limit(0)).count() == 0


def test_licenses_against_brute_force(odd):
    lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    for r in licenses.scan(odd).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(lower))
        at = [(i, t.label) for t in licenses.BASE for i in range(len(words)) if words[i : i + len(t.tokens)] == t.tokens]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert licenses.scan(odd.limit(0)).count() == 0


def test_warc_round_trip(spark):
    pages = [(1, "http://a/", "x\r\n\r\ny"), (2, None, "x\r\n\r\ny"), (None, "u", "x\r\n\r\ny"), (2, None, "x\r\n\r\ny"), (5, "http://b/Р\n", None), (4, "c", ""), (9, "d", "é\r\n")]
    archive = warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert archive.payloads.count() == 3
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.parse(warc.read(archive)).collect()), key=str)
    want = [(1, 6, "response", None), (2, 6, "revisit", 1), (2, 6, "revisit", 1), (None, 6, "revisit", 1), (5, 0, "revisit", 4), (4, 0, "response", None), (9, 4, "response", None)]
    assert got == sorted(want, key=str)
    assert warc.parse(warc.read(warc.write(spark.createDataFrame([], "page_id long, url string, html string")))).count() == 0


def test_warc_of_one_very_common_payload(spark, monkeypatch):
    monkeypatch.setattr(warc, "SHARE", 7)
    html = {k: "common " * 3 if k % 3 == 0 else f"page {k} " + "x" * (k % 50) * 1000 for k in range(300)}
    pages = spark.createDataFrame([(k, f"http://h/{k}", t, "x", "y") for k, t in html.items()], "page_id long, url string, html string, record string, copies string").repartition(5)
    archive = warc.write(pages)
    records = warc.read(archive)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = warc.read(archive)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Bucketed: true" in plan  # the few are read where they lie
    got = {r.page_id: r for r in warc.parse(records).collect()}
    assert len(got) == 300 and archive.payloads.count() == 201
    for k, t in html.items():
        first = k == 0 or k % 3
        assert (got[k].payload_bytes, got[k].record_type, got[k].refers_to) == (len(t), "response" if first else "revisit", None if first else 0)
    assert sorted(bytes(r.warc)[-4 - len(html[1]) : -4].decode() for r in records.collect() if b"urn:page:1>" in bytes(r.warc)[:80]) == [html[1]]


def test_url_filter_in_time(spark):
    entries = spark.createDataFrame([("l", "domain", "b.c", True, 10), ("l", "domain", "b.c", True, 10), ("l", "domain", "b.c", False, 20), ("m", "path", "a.b.c/x/", True, 15), (None, "host", "a", True, 1)], "list string, kind string, value string, active boolean, at int")
    urls = [("http://u@A.b.C:80/x/y?q", t) for t in (9, 10, 15, 20, None)] + [(None, 15), ("http://zb.c/x/", 15), ("http://zb.c/x/", 15)]
    got = url_filter.url_filter(spark.createDataFrame(urls, "url string, fetched_at int"), entries).collect()
    assert len(got) == len(urls)
    assert sorted((r.fetched_at, r.lists) for r in got if r.blocked) == [(10, "l"), (15, "l,m"), (20, "m")]


def test_quality_rules_counts(odd, labels):
    for r in quality_rules.judge(odd, labels).collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        seen = Counter(runs)
        repeated = {i + k for i, x in enumerate(runs) if seen[x] > 1 for k in range(5)}
        counts = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (len(words) < 10 or 100 * len(repeated) > 20 * len(words)) and not (r.base_failed and r.kept)
    assert quality_rules.judge(odd.limit(0), labels.limit(0)).count() == 0


def test_quality_odd_rows(odd, labels):
    rows = pu_quality.classify(odd, labels).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_quality(spark):
    d = SF.replace("0.001", "0.01")
    docs, marks = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for judged in (pu_quality.classify(docs, marks).filter("held_out"), quality_rules.judge(docs, marks)):
        rows = judged.join(marks, "doc_id").select("quality", "score").collect()
        good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
        assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.9


def test_near_duplicates_odd_rows(odd):
    rows = neardup.classes(odd).collect()
    assert len(rows) == len(ODD) and sum(r.kept for r in rows) == len({r.class_id for r in rows})
    cls = {r.doc_id: r.class_id for r in rows}
    assert cls[1] == cls[2] == 1 and cls[3] == 3 and cls[5] == 5
    assert neardup.dedup(odd).count() == sum(r.kept for r in rows) and neardup.dedup(odd).columns == odd.columns
    assert neardup.classes(odd.limit(0)).count() == 0


def test_near_duplicates_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")

    def shingles(text):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return {tuple(w)} if 0 < len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:]))

    sets = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    cls = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
    for i, (x, a) in enumerate(sets):
        for y, b in sets[:i]:
            if a and len(a & b) >= 0.8 * len(a | b):
                assert cls[x] == cls[y]
            elif not a & b and cls[x] == cls[y]:
                pytest.fail(f"{x} and {y} share nothing")


def test_document_frequencies_are_exact(spark):
    texts = [f"a b c d e f g h{i % 3} " + " ".join(f"w{i // 2}x{k}" for k in range(6)) for i in range(40)] + [None, "", "a b", "a b c d e f g"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = [(t or "").split() for t in texts]
    sets = [{tuple(w)} if 0 < len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:])) for w in words]
    held = Counter(x for s in sets for x in s)
    n, total = neardup.corpus_size(frame)
    assert (n, total) == (42, sum(map(len, words)))
    for bounds in ({"shingles_per_partition": 20, "chunk_bytes": 100}, {}):
        rows = neardup.signatures(frame, n, total, **bounds).collect()
        assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
        for r in rows:
            df = unpack(pa.scalar(r.df, pa.binary()), r.n, (np.uint64,))[0].tolist()
            assert sorted(df) == sorted(held[x] for x in sets[r.doc_id])


def test_near_duplicates_repeated_passages(spark):
    texts = {i: " ".join(f"t{i}w{k}" for k in range(120)) for i in range(25)}
    docs = [(i, t) for i, t in texts.items()] + [(100 + i, " ".join([t] * 10)) for i, t in texts.items()]
    cls = {r.doc_id: r.class_id for r in neardup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(set(cls.values())) == 25
    assert all(cls[i] == cls[100 + i] == i for i in texts)


def test_decontamination_against_brute_force(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) + " "
    texts = {r.item_id: plain(r.text) for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in texts.items() if t in plain(r.text)}
    planted = spark.createDataFrame([(10_000 + i, "before " * 9 + t.upper() + " after" * 9) for i, t in list(texts.items())[:5]] + [(1, None), (2, "")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs.select("doc_id", "text").union(planted), items, items_per_block=7).collect()}
    assert want <= got and {(10_000 + i, i) for i, t in list(texts.items())[:5] if t.isascii()} <= got
    assert all(d in {x for x, _ in want} or d >= 10_000 for d, _ in got)
    assert decontam.decontaminate(planted, items).count() <= 4 and decontam.contaminated(docs, items.limit(0)).count() == 0


def test_decontamination_reads_the_documents_once(spark, monkeypatch):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert len(decontam.blocks(items, 4)) >= 8
    out = decontam.contaminated(docs, items, items_per_block=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("ArrowEvalPython") == 1 and "Union" not in plan
    whole = sorted(map(tuple, decontam.contaminated(docs, items).collect()))
    assert whole and sorted(map(tuple, out.collect())) == whole
    monkeypatch.setattr(decontam, "INDEXES_HELD", 100)  # all blocks are held from batch to batch
    assert sorted(map(tuple, decontam.contaminated(docs, items, items_per_block=4).collect())) == whole


def test_lm_score_against_brute_force(spark, odd):
    docs = [(r[0], r[1]) for r in ODD] + [(20, "a b a b c"), (21, "a b d"), (22, "a b d")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    one, two, first = Counter(w for x in words for w in x), Counter(p for x in words for p in zip(x, x[1:])), Counter(w for x in words for w in x[:-1])
    total, want = sum(one.values()), []
    for (i, _), x in zip(docs, words):
        own2, own1, logs, seen = Counter(zip(x, x[1:])), Counter(x[:-1]), [], 0
        for p in zip(x, x[1:]):
            left = two[p] - own2[p]
            seen += left > 0
            logs.append(math.log(left / max(first[p[0]] - own1[p[0]], left)) if left else math.log(0.4 * max(one[p[1]] - own2[p], 1) / total))
        want.append((i, len(logs), seen, round(sum(logs) / len(logs), 4) if logs else None))
    key = lambda r: str(r)
    got = [(r.doc_id, r.n_pairs, r.n_seen, None if r.log_score is None else round(r.log_score, 4)) for r in lm_score.score(frame).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_lm_score_hot_words_and_pairs(spark):
    texts = ["the cat the dog the cat " * (1 + i % 4) + f"w{i} w{i % 7} the w{i % 5}" for i in range(60)] + [None, "", "the", "b" * 300 + " the cat"]
    docs = list(enumerate(texts))
    words = [(t or "").split() for t in texts]
    one, two, first = Counter(w for x in words for w in x), Counter(p for x in words for p in zip(x, x[1:])), Counter(w for x in words for w in x[:-1])
    want = {}
    for i, x in enumerate(words):
        own2, own1 = Counter(zip(x, x[1:])), Counter(x[:-1])
        left = [(two[p] - own2[p], first[p[0]] - own1[p[0]], max(one[p[1]] - own2[p], 1)) for p in zip(x, x[1:])]
        logs = [math.log(ab / a) if ab else math.log(0.4 * b / sum(one.values())) for ab, a, b in left]
        want[i] = (len(logs), sum(ab > 0 for ab, _, _ in left), sum(logs) / len(logs) if logs else None)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    frame.write.parquet(path := work_dir(spark, "lm-hot"))
    for bounds in ({"pairs_per_partition": 20}, {"pairs_per_partition": 20, "chunk_bytes": 200}, {}):
        got = lm_score.score(spark.read.parquet(path), **bounds).collect()
        assert len(got) == len(docs)
        for r in got:
            assert (r.n_pairs, r.n_seen) == want[r.doc_id][:2]
            assert r.log_score == (None if want[r.doc_id][2] is None else pytest.approx(want[r.doc_id][2], abs=1e-5))


def test_pipeline_stages(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert set(docs.columns) <= set(out.columns) and 0 < out.count()
    assert out.select("doc_id", "text").exceptAll(docs.select("doc_id", "text").union(docs.select("doc_id", "text"))).count() == 0
