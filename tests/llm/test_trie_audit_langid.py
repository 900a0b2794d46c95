"""Conversation trie, filter audit and language ID against brute force and held-out languages."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm import brute
from tests.llm.conftest import DOCS, LONG, docs_frame, write
from tickwise.llm import convtrie, filteraudit, langid, queries

TALK = "conv_id long, turn long, role string, text string, pos long, path string, container string, n long"
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def talk_frame(spark, rows):
    """Turns with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, "p", "c", None) for r in rows], TALK)


def nodes(df):
    return sorted((tuple(r) for r in df.select(*NODE).collect()), key=lambda r: r[:2])


# nulls, a turnless rebuilt conversation (600 has no 600 % 100 source and few turns), ties, repeated
# rows, a negative id, gaps in turns, empty texts, and copies of whole conversations
ODD = [(0, None, "user", "a"), (0, 0, None, "b"), (0, 1, "user", None), (0, 1, "user", "c"), (0, 1, "user", "c"),
       (1, 5, "user", "a"), (1, 9, "bot", LONG), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "user", ""),
       (-7, 0, "user", "a"), (-7, 1, "x:", "y"), (-7, 2, "x", ":y"), (None, 0, "user", "a"), (None, None, None, None),
       *[(c, t, "user", "same") for c in (601, 602, 603, 604, 605, 650) for t in range(3)],
       *[(c, t, "user", f"t{t}") for c in (700, 701, 710) for t in range(7)]]


def random_talk(seed, n=300):
    """Conversations that branch everywhere: shared runs, copies, prefixes of each other, long ones."""
    rng = random.Random(seed)
    seen, rows = [[]], []
    for c in rng.sample(range(-200, 3000), n):
        old = rng.choice(seen)
        turns = old[:rng.randint(0, len(old))] + [(rng.choice("ub"), "x" * rng.randint(0, 3))
                                                  for _ in range(rng.choice([0, 0, 1, 2, 5, 17]))]
        seen.append(turns)
        rows += [(c, t, *turn) for t, turn in enumerate(turns)]
    return rows


def test_trie_query_on_odd_rows(spark, tmp_path):
    folder = write(spark, str(tmp_path), conversations=talk_frame(spark, ODD))
    want = brute.trie(brute.rebuilt(ODD))
    got = nodes(queries.op11_conversation_trie(spark, folder))
    assert got == want
    assert (0, 0) in {r[:2] for r in want} or want[0][1] == 0


@pytest.mark.parametrize("segment,container", [(256, 1 << 15), (4, 8), (1, 3), (2, 1)])
def test_trie_of_any_segment_and_container_size(spark, segment, container):
    rows = random_talk(segment)
    convs = {}
    for c, _, role, text in rows:
        convs.setdefault(c, []).append((role, text))
    df = talk_frame(spark, rows).repartition(5)
    got = nodes(convtrie.prefix_trie(df, segment_turns=segment, container_turns=container))
    assert got == brute.trie(convs)


def test_trie_query_on_many_shapes(spark, tmp_path):
    rows = random_talk(77) + [(900, t, "u", "x") for t in range(600)] + [(912, t, "u", "x") for t in range(600)]
    folder = write(spark, str(tmp_path), conversations=talk_frame(spark, rows))
    assert nodes(queries.op11_conversation_trie(spark, folder)) == brute.trie(brute.rebuilt(rows))


def test_turns_of_a_conversation_split_over_partitions_are_numbered_on(spark):
    rows = [(5, t, "u", str(t)) for t in range(2000)] + [(6, 0, "u", "z")]
    got = convtrie.ordered_turns(talk_frame(spark, rows), "conv_id", "turn", "role", "text")
    assert sorted(r.pos for r in got.filter("conv = 5").collect()) == list(range(2000))
    assert [r.pos for r in got.filter("conv = 6").collect()] == [0]


def test_end_digests_string_ids_over_chunks(spark):
    import hashlib
    ends = spark.createDataFrame([(b"r", c) for c in range(-3, 2000)] + [(b"q", 7)], "row binary, conv long")
    got = {bytes(r.row): r.ends_sha256 for r in convtrie.end_digests(ends).collect()}
    assert got == {b"r": hashlib.sha256(",".join(map(str, range(-3, 2000))).encode()).hexdigest(),
                   b"q": hashlib.sha256(b"7").hexdigest()}


AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
         "shapley")


def test_filter_audit_on_odd_rows(spark, edge_dir):
    labels = [(1, 1, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (9, 0, 1), (9, 0, 0), (12, 1, 1), (99, 1, 1)]
    got = sorted(tuple(r) for r in queries.op12_filter_audit(spark, edge_dir).select(*AUDIT).collect())
    assert got == brute.filter_audit([(d, t, None) for d, t in DOCS], labels)


def test_filter_audit_by_parts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "B", "c#", "dd"] if k % 3 else ["one", f"w{j}"]) for j in range(rng.choice([3, 250])))
             for k in range(30)]
    docs = [(rng.choice([None, k, k, k // 2]), rng.choice([*texts, None]), rng.choice(["x", "y", None, ""]))
            for k in range(300)]
    labels = [(rng.randrange(300), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = filteraudit.filter_audit(df, "doc_id", "text", "lang",
                                   spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in got.select(*AUDIT).collect()) == brute.filter_audit(docs, labels)


def held_out_rows(spark, folder):
    docs = queries.table(spark, folder, "documents").select("doc_id", "lang")
    return queries.op13_language_id(spark, folder).join(docs, "doc_id").collect()


def test_language_of_held_out_documents(spark):
    rows = held_out_rows(spark, "/root/testdata/sf0.1")
    asked = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in asked) / len(asked) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)
    texts = queries.table(spark, "/root/testdata/sf0.1", "documents").count()
    assert len(rows) == texts


def test_language_on_odd_rows(spark, edge_dir, tmp_path):
    got = queries.op13_language_id(spark, edge_dir).collect()  # no row has a language
    assert len(got) == len(DOCS) and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    rows = [(d, t, "xx" if t and "quick" in t.lower() else "yy" if t and "lorem" in t else None) for d, t in DOCS]
    rows += [(k, "der hund und die katze " * (k % 5 + 1), "de") for k in range(100, 130)]
    rows += [(k, "12 34 !! \x00", "de") for k in range(130, 133)] + [(140, "😀" * 50, "de"), (141, "Ⅷ 日本", None)]
    folder = write(spark, str(tmp_path), documents=spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = queries.op13_language_id(spark, folder).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows)
    for d in (4, 5, 6, 130, 131, 132, 140):
        assert {(r.lang_pred, r.score) for r in by[d]} == {("und", 0.0)}
    assert all(r.lang_pred == "de" and r.score > 0.3 for k in range(100, 130) for r in by[k])
    assert all(r.lang_pred != "und" for r in by[141] + by[7]) and by[7][0].lang_pred == by[8][0].lang_pred
    assert sum(r.held_out for r in got) == sum(
        d is not None and brute.zlib.crc32(str(d).encode()) % 3 == 1 for d, *_ in rows)


def test_presence_kernel_against_sets():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdé .,日") for _ in range(rng.choice([0, 1, 2, 3, 50, 400]))) for _ in range(30)]

    def grams(text):
        t = langid.GAP.sub(" ", text.lower())
        return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    marks = langid.Landmarks(texts[:9])
    got = langid.product(texts, marks.vocabulary, marks.block, 9)
    want = [[len(grams(x) & grams(y)) / max(1, len(grams(x)) * len(grams(y))) ** .5 for y in texts[:9]] for x in texts]
    assert np.allclose(got, want, atol=1e-6)


def test_windows_of_a_long_text_lose_no_gram(monkeypatch):
    text = "".join(random.Random(2).choice("abcdefgh ") for _ in range(1000))
    whole = langid.features(text)
    monkeypatch.setattr(langid, "WINDOW", 7)
    assert (langid.features(text) == whole).all()
    monkeypatch.setattr(langid, "BLOCK", 5)
    marks = langid.Landmarks([text, "abc"])
    assert np.allclose(langid.product([text], marks.vocabulary, marks.block, 2)[0, 0], 1)


def test_language_sample_is_bounded_and_fair(spark):
    rows = spark.createDataFrame([(k, "some text", "en" if k % 20 else "xx") for k in range(4000)],
                                 "key long, text string, lang string")
    got = Counter(r.lang for r in langid.sample(rows, 150).collect())
    assert got == {"en": 150, "xx": 150}


def test_clashing_columns_are_ignored(spark):
    model = langid.Model([], np.array([], np.uint64), np.zeros((0, 0), np.float32))
    out = langid.identify(docs_frame(spark), "text", model)
    assert out.count() == len(DOCS) and {"lang_pred", "score", "row_key"} <= set(out.columns)
