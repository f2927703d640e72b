"""The stages of the pipeline against plain Python of their rules, and columns that clash."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telemetra.llm import mixing, neardup
from telemetra.llm.components import components
from telemetra.session import work_dir
from tests.test_entry import SF

WORD = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
STAGES = dict(corpus_pipeline.STAGES)
NAMES = ["size", "target", "taken", "copies", "positions", "src", "schedule", "_key", "_doc", "_kept", "_id", "score", "predicted", "held_out", "key", "row", "a b.c"]


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words_of(text)
    return Counter([tuple(w)] if 0 < len(w) < 5 else zip(w, w[1:], w[2:], w[3:], w[4:]))


@pytest.fixture(scope="module")
def staged(spark):
    """(input, output) of every stage on its own input, as the pipeline chains them."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        path = work_dir(spark, f"stage-{name}")
        step(spark, docs, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out[name] = (docs, result)
        docs = result
    return out


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_every_stage_keeps_rows_as_they_are(staged):
    for name, (before, after) in staged.items():
        same = before.columns
        assert same == after.columns[: len(same)] and (name == "shards" or same == after.columns)
        known = {tuple(r[c] for c in same) for r in _rows(before)}
        assert after.count() and all(tuple(r[c] for c in same) in known for r in _rows(after))


def test_quality_keeps_the_rows_judged_good(spark, staged):
    before, after = staged["quality"]
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in _rows(after)}
    held = [i for i in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((i in kept) == (marks[i] == 1) for i in held)
    assert right >= 0.8 * len(held) and 0.3 * before.count() < after.count() < before.count()


def test_dedup_keeps_one_of_each_class(staged):
    before, after = (_rows(x) for x in staged["near_duplicates"])
    sets, kept = {r["doc_id"]: shingles(r["text"]) for r in before}, {r["doc_id"] for r in after}
    ids = sorted(sets)
    df = Counter(x for s in sets.values() for x in s)
    n = sum(1 for s in sets.values() if s)
    weight = {i: {x: (1 + math.log(c)) * (1 + math.log(n / df[x]) / math.log(n)) for x, c in s.items()} for i, s in sets.items()}

    def similar(i, j):
        a, b = weight[i], weight[j]
        shared = a.keys() & b.keys()
        if not shared:
            return sets[i] == sets[j] and next(r["text"] for r in before if r["doc_id"] == i) == next(r["text"] for r in before if r["doc_id"] == j)
        low = sum(min(a[x], b[x]) for x in shared)
        return max(len(shared) / len(a.keys() | b.keys()), low / (sum(a.values()) + sum(b.values()) - low))

    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            if similar(i, j) >= 0.8 - 1e-6:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    # the smallest id of each class of linked texts, no more and no fewer
    assert kept == {i for i in ids if find(i) == i} and len(after) == len(kept)


def test_decontamination_drops_what_holds_an_item(spark, staged):
    before, after = (_rows(x) for x in staged["decontamination"])
    items = [words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in after}

    def weights(w, k):
        return Counter() if len(w) < k else sum((Counter({tuple(w[i : i + k]): sum(len(x.encode()) for x in w[i : i + k])}) for i in range(len(w) - k + 1)), Counter())

    held = set()
    index = defaultdict(set)
    for m, item in enumerate(items):
        k = min(5, len(item))
        for i in range(len(item) - k + 1):
            index[tuple(item[i : i + k])].add(m)
    for r in before:
        w = words_of(r["text"])
        near = {m for i in range(len(w)) for k in (1, 2, 3, 4, 5) for m in index.get(tuple(w[i : i + k]), ())}
        for m in near:
            k, size = min(5, len(items[m])), min(len(items[m]), len(w))
            want = weights(items[m], k)
            for s in range(len(w) - size + 1):
                have = weights(w[s : s + size], k)
                low, whole = sum((have & want).values()), sum((have | want).values())
                if whole and low / whole >= 0.8:
                    held.add((r["doc_id"], round(low / whole, 2)))
                    break
    lost = {i for i, _ in held}
    assert kept.isdisjoint(lost) and kept | lost == {r["doc_id"] for r in before}


def test_mix_takes_sources_to_their_targets(staged):
    before, after = (_rows(x) for x in staged["mix"])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = defaultdict(int)
    for r in before:
        total[r["source"]] += size(r["text"])
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(total.values()), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2 * total[s] for s in over}
        left -= sum(2 * total[s] for s in over)
        open_ -= over
    times = Counter(r["doc_id"] for r in after)
    assert max(times.values()) <= 2
    mixed = defaultdict(int)
    for r in after:
        mixed[r["source"]] += size(r["text"])
    longest = max(size(r["text"]) for r in before)
    assert all(abs(mixed[s] - target[s]) <= 2 * longest for s in names)


def test_shards_are_of_near_equal_bytes(staged):
    before, after = (_rows(x) for x in staged["shards"])
    assert len(before) == len(after)
    assert sorted(map(str, (r["doc_id"] for r in before))) == sorted(map(str, (r["doc_id"] for r in after)))
    sums = Counter()
    for r in after:
        sums[r["shard"]] += r["size"]
    longest = max(r["size"] for r in after)
    assert max(sums.values()) - min(sums.get(k, 0) for k in range(24)) <= 2 * longest


@pytest.mark.parametrize("stage", ["quality", "near_duplicates", "decontamination", "mix"])
def test_clashing_columns_come_back(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    own = docs.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id")).alias(c) for c in NAMES])
    out = STAGES[stage](spark, own, SF)
    assert out.columns == own.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in NAMES)


@pytest.mark.parametrize("stage", list(STAGES))
def test_stages_of_odd_and_empty_tables(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "of two roads that part in a yellow wood one is taken by most who walk there and the other by a few " * 3
    odd = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, text, "en", None, 1), (3, text, None, "a", 1), (3, text, None, "a", 1), (None, None, None, None, None)]
    frame = spark.createDataFrame(odd, schema)
    assert STAGES[stage](spark, frame, SF).count() <= 2 * len(odd)
    assert STAGES[stage](spark, frame.limit(0), SF).count() == 0


def test_late_links_merge_components(spark, monkeypatch):
    """Texts that only the comparison across components links end in one class."""
    base = [f"w{k}" for k in range(200)]
    chain = [" ".join(base[4 * i : 4 * i + 150]) for i in range(8)]  # each alike its neighbours only
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(chain)] + [(100, "else " * 30)], "doc_id long, text string")
    for bands in (neardup.BANDS, 2):
        monkeypatch.setattr(neardup, "BANDS", bands)
        monkeypatch.setattr(neardup, "_tables", [])
        cls = {r.doc_id: r.class_id for r in neardup.classes(docs).collect()}
        if bands > 2:
            assert {cls[i] for i in range(8)} == {0}
        assert cls[100] == 100


def test_components_of_a_path(spark):
    n = 40
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_mix_and_dedup_columns_as_read(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 7, "k"), (2, "d e f", "s", 8, "l")], "doc_id long, text string, source string, size long, src string")
    assert {r.size for r in mixing.emit(docs).collect()} <= {7, 8}
    assert sorted(map(tuple, neardup.dedup(docs).collect())) == sorted(map(tuple, docs.collect()))


def test_mix_follows_the_curriculum_into_the_shards(spark):
    docs = spark.createDataFrame([(i, f"{i} " + "w " * (5 + i % 7), "en", "abc"[min(i % 8, 2)], i) for i in range(900)], "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    at = [(p, r["_key"], r.doc_id, r.source) for r in mixing.mix(docs).filter("copies > 0").collect() for p in r.positions[: r.copies]]
    want = [i for _, _, i, _ in sorted(at)]
    assert len(want) > len(set(want)) > 600 and want != sorted(want)

    mixed, path = STAGES["mix"](spark, docs, SF), work_dir(spark, "in-training-order")
    assert [r.doc_id for r in mixed.collect()] == want
    mixed.repartitionByRange(3, "doc_id").write.parquet(path + "-other")  # files in another order
    mixed.write.option("maxRecordsPerFile", 70).parquet(path)
    read = spark.read.parquet(path)
    assert len(read.inputFiles()) > 10
    for frame in (read, mixed):  # from files, and from none
        rows = STAGES["shards"](spark, frame, SF).collect()
        assert len(rows) == len(want) and len({(r.shard, r.slot) for r in rows}) == len(rows)
        of, split = {}, set()
        for r in rows:
            split |= {r.doc_id} if of.setdefault(r.doc_id, r.shard) != r.shard else set()
        assert len(split) < 24
        for s in range(24):
            own = sorted((r for r in rows if r.shard == s), key=lambda r: r.slot)
            assert [r.slot for r in own] == list(range(len(own)))
            assert [r.doc_id for r in own if r.doc_id not in split] == [i for i in want if of[i] == s and i not in split]
    again = {(r.doc_id, r.shard) for r in STAGES["shards"](spark, spark.read.parquet(path + "-other"), SF).collect()}
    assert sum(pair not in {(r.doc_id, r.shard) for r in rows} for pair in again) <= 24  # the order moves slots, not shards


def test_shards_keep_columns_named_like_the_files(spark):
    docs = spark.createDataFrame([(i, f"text {i}", f"own {i}") for i in range(40)], "doc_id long, text string, _metadata string")
    path = work_dir(spark, "own-metadata")
    docs.write.parquet(path)
    for frame in (docs, spark.read.parquet(path)):
        rows = STAGES["shards"](spark, frame, SF).collect()
        assert len(rows) == 40 and all(r["_metadata"] == f"own {r.doc_id}" for r in rows)
