"""The corpus pipeline, stage by stage, against brute force, and the registered queries."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from test_texts import brute_components, brute_counts, brute_fingerprint, brute_repeats

from pyspark.sql import functions as F

from triagelake.llm import catalog, mixing, outliers, repeats
from triagelake.session import materialise


def test_stages(spark, small):
    folder, docs = "/root/testdata/sf0.001", small
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_dedup", "substring_dedup", "mix_sources", "pack_sequences"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = materialise(stage(spark, docs, folder), f"test-{name}")
        seen[name] = (before, docs.collect())
        if name != names[-1]:
            assert docs.columns == small.columns
    before, after = seen["quality_rules"]
    failed = {r.doc_id for r in before if (c := brute_counts(r.text))[0] < 20 or 100 * c[4] > 30 * c[0]}
    assert not failed & {r.doc_id for r in after} and set(after) <= set(before) and len(after) > 0.7 * len(before)
    before, after = seen["simhash_dedup"]
    prints = [brute_fingerprint(r.text) for r in before]
    classes = brute_components([r.doc_id for r in before], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    assert set(after) == {r for r, c in zip(before, classes) if r.doc_id == c} and len(after) == len(set(classes))
    before, after = seen["substring_dedup"]
    removed = {i: (n, gone) for i, n, gone, _ in brute_repeats([(r.doc_id, r.text) for r in before])}
    whole = {r.doc_id: r for r in before}
    assert {r.doc_id for r in after} == {i for i, (n, gone) in removed.items() if gone == 0 or gone < n}
    for r in after:
        n, gone = removed[r.doc_id]
        assert len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) == n - gone and (gone or r == whole[r.doc_id])
        assert not gone or r.n_chars == len(r.text)
    before, after = seen["mix_sources"]
    assert set(after) <= set(before) and len(after) > len(before) / 2
    before, after = seen["pack_sequences"]
    pieces = Counter((r.doc_id, r.piece) for r in after)
    assert Counter(r.doc_id for r in before) == Counter({i: n for (i, k), n in pieces.items() if k == 0})


def test_stages_take_repeated_and_null_ids(spark, docs_of):
    text = " ".join(f"word{i}" for i in range(40))
    docs = docs_of([(1, text), (1, text + " x"), (None, text), (None, " ".join(f"other{i}" for i in range(50))), (2, text), (3, None)])
    got = corpus_pipeline.simhash_dedup(spark, docs, "").collect()
    assert Counter(r.doc_id for r in got)[1] == 1 and len(got) == len({r.doc_id for r in got})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), "").collect() == []


def test_every_component_keeps_one_row(spark, docs_of):
    texts = [" ".join(f"{name}{i}" for i in range(40)) for name in ("one", "two", "three", "four", "five")]
    rows = [(1, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2] + " with more"), (2, texts[3]), (2, texts[4]), (2, texts[4]), (3, texts[3]), (0, None), (None, "")]
    got = corpus_pipeline.simhash_dedup(spark, docs_of(rows), "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        [(1, texts[0]), (None, texts[1]), (None, texts[2] + " with more"), (2, texts[3]), (2, texts[4]), (0, None)])


#: Names that operators and stages use on their way.
INNER = (
    "level x_length x_symbols x_lines x_repeats n_words word_chars n_symbols n_dup_lines n_repeat_words kept distance base_failed _lang _source "
    "_m _m0 _m1 _m2 cdf first _first _u _row none _to _from kind a b c n_removed copy n_copies rate shuffle_key fp fingerprint root node component_id "
    "_id _no_id _text text_hash piece start length sequence_id offset ids_crc32 weight n").split()


def test_columns_named_like_inner_ones_pass_through(spark, docs_of):
    words = [" ".join(f"{name}{i}" for i in range(40)) for name in ("one", "two", "three")]
    rows = [(i, f"{words[i % 3]} own{i}x {' '.join(f'more{i}n{k}' for k in range(30))}", "en" if i % 2 else None, None if i % 5 == 0 else "s") for i in range(30)]
    docs = docs_of(rows)
    docs = docs.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id").cast("string")).alias(name) for name in INNER])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(r[c] == f"{c} {r.doc_id}" for r in got for c in INNER), name
    assert corpus_pipeline.pack_sequences(spark, docs, "").count() >= 30
    for made in (mixing.replicate(docs), repeats.cut_repeats(docs), outliers.judged(docs), outliers.judged(docs, False)):
        assert all(r[c] == f"{c} {r.doc_id}" for r in made.collect() for c in ("cdf", "level", "_to", "_u", "_first", "_row"))


def test_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalog.queries())
    assert numbers == list(range(1, 14)) and set(catalog.oracle_sql()) <= set(catalog.queries())


def test_native_formatting_has_no_python(spark):
    plan = catalog.op3_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sql_restatements(spark):
    from check_queries import compare, duck

    con = duck("/root/testdata/sf0.001")
    for name, statement in catalog.oracle_sql().items():
        assert compare(catalog.queries()[name](spark, "/root/testdata/sf0.001"), con, statement) == "", name
