"""Operators over documents against brute force, on odd rows and on the sf0.001 table."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF001
from tests.llm import brute
from tests.llm.conftest import DOCS, ITEMS, LONG, docs_frame
from tickwise.llm import bpe, queries, simhash
from tickwise.llm.common import with_row_key


def documents(folder):
    return duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()


def run(spark, name, folder, *columns):
    df = queries.QUERIES[name](spark, folder)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    df = queries.QUERIES[name](spark, empty_dir)
    assert df.collect() == [] and df.columns


def test_line_dedup_on_odd_rows(spark, edge_dir):
    got = run(spark, "op2_line_dedup", edge_dir, "doc_id", "text", "n_dropped")
    assert len(got) == len(DOCS)
    # the first of equal or near lines stays; each line is kept once over all rows
    lines = [x for _, t, _ in got for x in (t or "").split("\n") if brute.visible(x)]
    assert len(lines) == len(set(lines))
    by = {}
    for d, t, n in got:
        by.setdefault(d, []).append((t, n))
    assert by[1] == [("The quick brown fox jumps over the lazy dog near the river bank today\nSecond line here", 0)]
    assert by[2] == [("", 2)] and by[4] == [(None, 0)] and by[5] == [("", 0)] and by[6] == [(" \t\n", 0)]
    assert by[15] == [("x\n\n \nShort line\nThis line is long enough to have a near copy of itself, is it not?", 2)]
    assert by[16] == [("y", 1)]


def test_line_dedup_against_brute_force(spark):
    rows = documents(SF001)
    want = sorted(zip((d for d, _ in rows), brute.dedup_lines(rows), strict=True))
    assert run(spark, "op2_line_dedup", SF001, "doc_id", "text") == sorted(want, key=repr)


def test_simhash_on_odd_rows(spark, edge_dir):
    want = sorted(brute.simhash(DOCS), key=repr)
    assert run(spark, "op7_simhash", edge_dir, "doc_id", "fingerprint", "component_id") == want


def test_simhash_against_brute_force(spark):
    want = sorted(brute.simhash(documents(SF001)), key=repr)
    assert run(spark, "op7_simhash", SF001, "doc_id", "fingerprint", "component_id") == want


def test_decontamination_on_odd_rows(spark, edge_dir):
    df = queries.op6_decontaminate(spark, edge_dir)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in df.collect()), key=repr)
    want = brute.contamination(DOCS, ITEMS)
    assert got == sorted(((d, n, h, len(i)) for d, n, h, i in want), key=repr)
    assert any(i == ["", "1"] or i == ["2"] for *_, i in want)


def test_bpe_on_odd_rows(spark, edge_dir):
    got = run(spark, "op9_bpe", edge_dir, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(brute.bpe(DOCS), key=repr)


def test_bpe_of_every_code_point_equals_the_library():
    theirs = tokenizers.Tokenizer.from_file(queries.TOKENIZER)
    mine = bpe.Tokenizer(bpe.read_vocabulary(queries.TOKENIZER), bpe.unicode_tables())
    tables = bpe.unicode_tables()
    odd = [c for k in ("classes", "inert") for a, b in tables[k] for c in range(a, b + 1)]
    odd += map(ord, tables["lower"])
    assert len(odd) > 10_000
    frames = ["x%sy", "7%s8", "!%s?", "a%s\u0323\u0301", "e\u0301%s\u0327%s", "Σ%s Ⱥ", "\U00011935%s\U00011930"]
    texts = [" ".join(f.replace("%s", chr(c)) for f in frames) for c in odd]
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    texts += [every[i:i + 512] for i in range(0, len(every), 512)]
    rng = random.Random(3)
    pool = "".join(map(chr, odd)) + "aZ1 '!\u0301\u0327\u0345\u0334" * 1000
    texts += ["".join(rng.choices(pool, k=40)) for _ in range(5000)]
    for text, want in zip(texts, theirs.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == want.ids, ascii(text)


def test_bpe_against_the_library(spark):
    got = run(spark, "op9_bpe", SF001, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(brute.bpe(documents(SF001)), key=repr)


def test_quality_rules_on_odd_rows(spark, edge_dir):
    import re
    from collections import Counter
    got = run(spark, "op3_quality_rules", edge_dir, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
              "n_repeat_words", "base_failed")
    want = []
    for d, t in DOCS:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        seen = Counter(tri)
        rep = len({i + k for i, g in enumerate(tri) if seen[g] > 1 for k in range(3)})
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")),
                     len(lines) - len(set(lines)), rep, len(w) < 50 or 100 * rep > 50 * len(w)))
    assert got == sorted(want, key=repr)


def test_toxicity_on_odd_rows(spark, edge_dir):
    got = run(spark, "op1_toxicity", edge_dir, "doc_id", "held_out", "score", "predicted")
    assert len(got) == len(DOCS)
    assert all(0 <= s <= 1 and p == (s >= 0.3) for _, _, s, p in got)


@pytest.mark.parametrize("toxic", [lambda k: k % 2, lambda k: 1, lambda k: 0])
def test_toxicity_with_nothing_to_tell_by_keeps_every_document(spark, tmp_path, toxic):
    from tests.llm.conftest import write
    folder = write(spark, str(tmp_path),
                   documents=docs_frame(spark, [(k, f"plain words of text number {k % 7}") for k in range(40)]),
                   labels=spark.createDataFrame([(k, 1, toxic(k)) for k in range(40)], "doc_id long, quality int, toxic int"))
    got = run(spark, "op1_toxicity", folder, "doc_id", "score", "predicted")
    assert len(got) == 40 and {r[1:] for r in got} == {(0.0, 0)}
    docs = queries.table(spark, folder, "documents")
    assert corpus_pipeline.STAGES[0][1](spark, docs, folder).count() == 40


def test_small_samples_are_dictionaries_whole():
    from tickwise.llm import toxicity
    samples = [f"sample {i}".encode() for i in range(300)]
    assert toxicity._dictionary(8192, samples, 16) == b" ".join(samples)
    assert toxicity._dictionary(1024, samples[:30], 16) == b" ".join(samples[:30])


def test_toxicity_on_held_out_labels(spark):
    scores = queries.op1_toxicity(spark, "/root/testdata/sf0.1")
    labels = queries.table(spark, "/root/testdata/sf0.1", "labels")
    rows = scores.filter("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.02


def test_shards_hold_every_id_once_in_training_order(spark, edge_dir):
    import struct

    import numpy as np

    from tickwise.llm import shards
    docs = docs_frame(spark)
    manifest = shards.materialise(docs, "doc_id", "text", queries.RANKS, public_tokenizers.PATTERN,
                                  queries.END_OF_TEXT, length=16, shard_slots=50)
    files = manifest.collect()
    records = []
    for f in files:
        for slot, raw in shards.read_slots(f.file, f.first_slot, f.records, f.stride):
            number, doc, offset, n, _ = struct.unpack_from(shards.HEAD, raw)
            records.append((number, slot, doc, offset, np.frombuffer(raw, "<u2", n, shards.HEAD_BYTES).tolist()))
    records.sort()
    n = len(records)
    assert [r[0] for r in records] == list(range(n)) and sorted(r[1] for r in records) == list(range(n))
    permute = shards.Permutation(n)
    assert permute(np.arange(n)).tolist() == [r[1] for r in records]
    assert permute(permute(np.arange(n)), backwards=True).tolist() == list(range(n))
    # byte-level ids decode to the very texts; sequences follow each other in their documents
    encoding = shards.encoding(bpe.read_vocabulary(queries.RANKS), public_tokenizers.PATTERN)
    texts, cur = [], []
    for _, _, doc, offset, ids in records:
        assert offset == len(cur)
        for i in ids:
            if i == queries.END_OF_TEXT:
                texts.append(encoding.decode(cur))
                cur = []
            else:
                cur.append(i)
    assert not cur and sorted(texts) == sorted(t or "" for _, t in DOCS)
    # reading goes on from any slot
    later = [s for f in files for s, _ in shards.read_slots(f.file, f.first_slot, f.records, f.stride, start=n - 7)]
    assert sorted(later) == list(range(n - 7, n))
    assert shards.read_sequences(manifest, start=n - 7).count() == 7


def test_shards_are_the_same_however_the_rows_are_dealt(spark):
    """Byte by byte, also with documents that span sequences and pieces, repeated rows and id -1."""
    from tickwise.llm import shards
    rows = [*DOCS, (-1, "minus one"), (None, "null"), (7, LONG)]

    def files(docs):
        manifest = shards.materialise(docs, "doc_id", "text", queries.RANKS, public_tokenizers.PATTERN,
                                      queries.END_OF_TEXT, length=64, shard_slots=16)
        return [(f.shard, f.records, open(f.file, "rb").read())
                for f in manifest.orderBy("shard").collect()], manifest

    one, manifest = files(docs_frame(spark, rows).coalesce(1))
    many, _ = files(docs_frame(spark, rows[::-1]).repartition(7))
    assert one == many and len(one) > 10
    firsts = [(r.doc_id, r.doc_offset) for r in shards.read_sequences(manifest).orderBy("sequence").collect()]
    assert firsts == [(d, o) for _, d, o, _ in shard_sequences(rows, 64)]


def shard_sequences(rows, length):
    """(sequence, document, offset, ids) of all rows in order of their ids, by brute force."""
    import xxhash

    from tickwise.llm import shards
    encoding = shards.encoding(bpe.read_vocabulary(queries.RANKS), public_tokenizers.PATTERN)
    order = sorted(((d is not None, d or 0, xxhash.xxh3_128_digest((t or "").encode()), t or "") for d, t in rows))
    run = [(d if known else None, k, i) for known, d, _, t in order
           for k, i in enumerate([*encoding.encode_ordinary(t), queries.END_OF_TEXT])]
    return [(s, *run[at][:2], [i for _, _, i in run[at:at + length]])
            for s, at in enumerate(range(0, len(run), length))]


def test_shards_query_against_brute_force(spark, edge_dir):
    import hashlib
    import struct

    import numpy as np

    from tickwise.llm import shards
    got = sorted(tuple(r) for r in queries.op8_shards(spark, edge_dir).select(
        "sequence", "slot", "doc_id", "doc_offset", "n_tokens", "ids_sha256").collect())
    want = shard_sequences(DOCS, shards.LENGTH)
    slots = shards.Permutation(len(want))(np.arange(len(want))).tolist()
    assert got == [(s, slots[s], d, o, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}H", *ids)).hexdigest())
                   for s, d, o, ids in want]


def test_shards_are_read_back_by_several_tasks(spark, tmp_path, monkeypatch):
    from tickwise.llm import shards
    monkeypatch.setattr(shards, "TASK_BYTES", 1 << 16)
    manifest = shards.materialise(docs_frame(spark), "doc_id", "text", queries.RANKS, public_tokenizers.PATTERN,
                                  queries.END_OF_TEXT, length=64, shard_slots=16)
    read = shards.read_sequences(manifest)
    tasks = read.select(F.spark_partition_id().alias("task")).distinct().count()
    assert read.count() == manifest.agg(F.sum("records")).first()[0] and tasks > 2


def test_simhash_finds_dense_groups_and_splits_large_buckets(spark):
    import random

    import numpy as np
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    codes = list(base)
    for b in base[:4]:  # dense groups: chains of codes two bits apart
        for _ in range(120):
            b ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            codes.append(b)
    codes = sorted(set(codes))
    frame = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fingerprint long")
    sets = brute.Sets(range(len(codes)))
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= 3:
                sets.join(i, j)
    want = {}
    for i, c in enumerate(codes):
        want.setdefault(sets.root(i), set()).add(int(np.uint64(c).view(np.int64)))
    for bucket_rows in (1024, 8):
        got = {}
        for r in simhash.fingerprint_roots(frame, bucket_rows=bucket_rows).collect():
            got.setdefault(r.root, set()).add(r.code)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_thresholds_keep_the_pigeonhole_sum():
    import numpy as np
    both = np.full((64, 64), 250.0) + np.eye(64) * 250
    for n in (10, 1000, 10**6, 10**9):
        plan = simhash.search_plan(n, both * n / 1000)
        assert all(t >= 0 for _, t in plan)
        bits = [b for g, _ in plan for b in g]
        assert len(bits) == len(set(bits))
        # parts that are left out have threshold -1 and add nothing to the sum
        assert sum(t + 1 for _, t in plan) == simhash.DISTANCE + 1


def correlated_codes():
    """Codes whose upper half repeats the lower one, with a few bits changed here and there."""
    rng = random.Random(5)
    codes = {lo | lo << 32 for lo in (rng.getrandbits(32) for _ in range(600))}
    for c in sorted(codes)[:300]:
        for flips in (1, 2, 3, 4):
            for b in rng.sample(range(64), flips):
                c ^= 1 << b
            codes.add(c)
    return sorted(codes)


def test_estimate_knows_correlated_bits():
    rng = np.random.default_rng(6)  # unrelated codes: the estimate is of candidates that are no links
    low = rng.random((2000, 32)) < 0.5
    bits = np.concatenate([low, low ^ (rng.random(low.shape) < 0.05)], 1).astype(float)
    differ = simhash.differences(len(bits), bits.T @ bits)
    group = [*range(6), *range(32, 38)]  # six bits and their copies
    x = (bits[:, None, group] != bits[None, :, group]).sum(2)[np.triu_indices(len(bits), 1)]
    for t, share in enumerate(simhash.within(differ, group, 3)):
        assert abs(share - (x <= t).mean()) < 0.1 * (x <= t).mean(), t
    assert np.prod(1 - differ.diagonal()[group]) < 0.2 * (x == 0).mean()  # bits taken as independent
    assert simhash.within(np.zeros((64, 64)), group, 3) == [1.0] * 4


def test_unequal_thresholds_find_every_link(spark, monkeypatch):
    codes = correlated_codes()
    monkeypatch.setattr(simhash, "PAIR_COST", 20.0)  # as a larger table would weigh candidates
    frame = spark.createDataFrame([(int(np.uint64(c).view(np.int64)),) for c in codes], "fingerprint long")
    plan = simhash.search_plan(*simhash.bit_statistics(frame.toDF("code")))
    assert len({t for _, t in plan}) > 1 and sum(t + 1 for _, t in plan) == simhash.DISTANCE + 1
    sets = brute.Sets(range(len(codes)))
    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= 3:
                sets.join(i, j)
    want = {}
    for i, c in enumerate(codes):
        want.setdefault(sets.root(i), set()).add(int(np.uint64(c).view(np.int64)))
    got = {}
    for r in simhash.fingerprint_roots(frame).collect():
        got.setdefault(r.root, set()).add(r.code)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert 1 < max(map(len, got.values())) and len(got) < len(codes)


def test_pipeline_stages_on_odd_rows(spark, edge_dir):
    docs = docs_frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, edge_dir)
        assert out.schema.names == docs.schema.names, name
        kept = {(r.doc_id, r.text) for r in out.collect()}
        if name == "toxicity":
            assert out.count() <= len(DOCS)
        elif name == "line dedup":
            assert out.count() == len(DOCS)
        elif name == "SimHash near-dedup":
            want = {min((d is None, d or 0) for d, _, k in brute.simhash(DOCS) if k == c and d is not None)[1]
                    for c in {k for *_, k in brute.simhash(DOCS) if k is not None}}
            assert {d for d, _ in kept if d is not None} == want
        else:
            want = {(d, t) for (d, t), (_, _, h, _) in zip(DOCS, brute.contamination(DOCS, ITEMS), strict=True) if not h}
            assert kept == want


def test_pipeline_against_brute_force(spark):
    docs = queries.table(spark, SF001, "documents")
    rows, key = with_row_key(docs, "doc_id")
    toxic = {r.doc_id for r in queries.op1_toxicity(spark, SF001).filter("predicted = 1").collect()}
    left = [(d, t) for d, t in documents(SF001) if d not in toxic]
    left = list(zip((d for d, _ in left), brute.dedup_lines(left), strict=True))
    stays = {k for *_, k in brute.simhash(left)}
    left = [(d, t) for d, t in left if d in stays]
    hits = brute.contamination(left, duckdb.sql(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall())
    left = [r for r, h in zip(left, hits, strict=True) if not h[2]]
    got = corpus_pipeline.run(spark, SF001).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute.bpe(left))


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_pipeline_stages_on_empty_tables(spark, empty_dir, stage):
    docs = queries.table(spark, empty_dir, "documents")
    assert corpus_pipeline.STAGES[stage][1](spark, docs, empty_dir).collect() == []


def test_memos_do_not_follow_text_without_spaces():
    import random
    import tracemalloc
    rng = random.Random(1)
    tokenizer = bpe.Tokenizer(bpe.read_vocabulary(queries.TOKENIZER), bpe.unicode_tables())
    tracemalloc.start()
    for _ in range(60):
        tokenizer.encode("".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(3000)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 1e6 and not tokenizer.by_chunk


def test_a_task_gives_back_the_memory_it_leaves_free(spark, monkeypatch):
    import re
    from pathlib import Path

    import pyarrow as pa
    from pyspark.sql import types as T

    from tickwise.llm import common

    def held_mb() -> float:
        found = re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
        return int(found[1]) / 1024

    tasks, pins = [], []
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: tasks.append(run))

    def make():
        memo = []

        def work(texts):
            memo.extend(bytes(2000) for _ in range(50_000))
            pins.append(bytes(2000))  # lives on above the memo, as what a worker keeps does
            return [pa.array([len(t) for t in texts], pa.int64())]

        return work

    common.append_columns(docs, "text", [T.StructField("n", T.LongType())], make)
    before = held_mb()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["abc"]})
    assert [b.to_pydict() for b in tasks[0](iter([batch]))] == [{"doc_id": [1], "n": [3]}]
    assert held_mb() - before < 30
