"""The pipeline, stage by stage, against plain versions on its own input; the classifier, quality rules and mix on their edges."""

import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from seriesmill.llm import mixing, piece_codec, quality_classifier, quality_rules
from seriesmill.llm.queries import QUERIES, tokenizer

from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), [spark.read.parquet(f"{SF}/documents.parquet")]
    root = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out.append(docs)
    return out


def test_stages_return_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:5])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_duplicates", "near_duplicates", "mix", "encode"]


def test_quality_stage(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    known = [(d.doc_id in kept, labels[d.doc_id]) for d in stages[0].collect() if d.doc_id in labels]
    assert np.mean([k for k, q in known if q == 1]) > 0.97 and np.mean([not k for k, q in known if q == 0]) > 0.8


def test_exact_stage(stages):
    groups = {}
    for r in stages[1].collect():
        groups.setdefault(lower(r.text), []).append(r.doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(max(g) for g in groups.values())


def test_near_stage(stages):
    rows = stages[2].collect()
    want = set(plain_components([r.doc_id for r in rows], [plain_fingerprint(r.text) for r in rows]))
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(want)


def test_mix_stage(stages):
    before, after = stages[3].collect(), stages[4].collect()
    assert max(Counter(r.doc_id for r in after).values()) <= 2
    total = sum(len(words(r.text)) for r in before)
    longest = max(len(words(r.text)) for r in before)
    assert 1.5 * total - 2 * longest <= sum(len(words(r.text)) for r in after) <= 1.5 * total
    plan = {r.doc_id: r.taken for r in mixing.plan(stages[3]).collect()}
    count = Counter(r.doc_id for r in after)
    assert all(plan[r.doc_id] == count[r.doc_id] * len(words(r.text)) for r in before)


def test_encode_stage(stages):
    library = piece_codec.processor(tokenizer("piece_bpe_32k.model"))
    want = sorted((r.doc_id, len(library.encode(r.text or "", add_eos=True))) for r in stages[4].collect())
    assert sorted((r.doc_id, r.n_tokens) for r in stages[5].collect()) == want


def test_run_is_the_stages(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[5].collect()))


def test_every_query_is_registered():
    assert [re.match(r"op(\d+)_", n)[1] for n in QUERIES] == [str(n) for n in range(1, 14)]


# --- the classifier -----------------------------------------------------------------------------------------------------


def test_sample_has_one_row_of_each_document_and_all_its_chunks(spark):
    long = "some words " * 11_000
    docs = spark.createDataFrame([(1, f"copy {i}") for i in range(50)] + [(2, long), (3, None)], "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    net = quality_classifier.Net()
    got = {r.doc_id: (bytes(r.text).decode(), r.y) for r in quality_classifier.sample(docs, labels, net).collect()}
    assert set(got) == {1, 2, 3} and got[2] == (long, 0) and got[3] == ("", 0) and got[1][0].startswith("copy ")
    bounded = quality_classifier.sample(docs, labels, quality_classifier.Net(per_class=1)).collect()
    assert sorted(r.y for r in bounded) == [0, 1]


def test_every_part_of_a_long_text_is_learned_from(spark):
    """What tells the labels apart stands in one chunk of a text of a megabyte, far behind its beginning; its bytes' filters move, those of others don't."""
    sizes = dict(chunk=512, filters=4, batch=4, decay=0.0)
    filler = "abcdefgh" * 125_000
    texts = [filler[:700_000] + mark * 8 + filler[700_000:] for mark in "QZ"]
    docs = spark.createDataFrame([(1, texts[0]), (2, texts[1])], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    model = quality_classifier.train(docs, labels, quality_classifier.Net(steps=5, **sizes))
    before = quality_classifier.fit([(b"a", 0), (b"b", 1)], quality_classifier.Net(steps=0, **sizes))
    moved = {c: bool((model.filters[:, ord(c)] != before.filters[:, ord(c)]).any()) for c in "QZ~"}
    assert moved == {"Q": True, "Z": True, "~": False}


def test_chunks_cover_every_window():
    net = quality_classifier.Net(width=4, chunk=16)
    for n in range(0, 120):
        text = bytes(range(1, n + 1))
        chunks = quality_classifier.chunked(text, net)
        found = {bytes(c[i : i + 4]) for c in chunks for i in range(13)}
        assert all(text[i : i + 4] in found for i in range(max(0, n - 3)))


def test_scores_follow_the_filters():
    net = quality_classifier.Net(chunk=32, filters=3)
    rng = np.random.default_rng(0)
    model = quality_classifier.Model(net, rng.normal(size=(6, 256, 3)).astype(np.float32), rng.normal(size=3), rng.normal(size=3), 0.1)
    texts = [b"", b"abc", bytes(rng.integers(1, 255, 500, dtype=np.uint8)), bytes(rng.integers(1, 255, 33, dtype=np.uint8))]
    got = quality_classifier.scores(texts, model, at_once=3)
    for t, s in zip(texts, got):
        chunks = quality_classifier.chunked(t, net)
        h = [[max(0, max(sum(model.filters[j][c[i + j]][f] for j in range(6)) + model.bias[f] for i in range(net.hop))) for f in range(3)] for c in chunks]
        assert s == pytest.approx(1 / (1 + np.exp(-(np.mean(h, axis=0) @ model.out + 0.1))), abs=1e-4)


def test_fit_learns_a_pattern_and_is_repeatable():
    """Texts differ by one word; a net of few filters tells new ones apart, and its loss falls where each part is trained."""
    rng = np.random.default_rng(3)
    net = quality_classifier.Net(chunk=64, filters=4, steps=200, batch=16)
    noise = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8))
    text = lambda y: noise(int(rng.integers(0, 90))) + (b" sound " if y else b" worse ") + noise(int(rng.integers(0, 90)))
    samples = [(text(i % 2), i % 2) for i in range(120)]
    model, again = (quality_classifier.fit(samples, net) for _ in range(2))
    assert (model.filters == again.filters).all() and model.out_bias == again.out_bias
    fresh = [(text(i % 2), i % 2) for i in range(200)]
    found = quality_classifier.scores([t for t, _ in fresh], model)
    assert np.mean([(s > 0.5) == bool(y) for s, (_, y) in zip(found, fresh)]) > 0.95
    untrained = quality_classifier.fit(samples, quality_classifier.Net(chunk=64, filters=4, steps=1, batch=16))
    loss = lambda m: -np.mean([np.log(s if y else 1 - s) for s, (_, y) in zip(np.clip(quality_classifier.scores([t for t, _ in fresh], m), 1e-9, 1 - 1e-9), fresh)])
    assert loss(model) < 0.3 * loss(untrained)


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "some text", "y"), (2, "", "z")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (3, 7)], "doc_id long, quality int")
    rows = quality_classifier.predictions(docs.drop("score"), labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows}) == 1
    assert quality_classifier.keep_good(docs, labels).columns == docs.columns
    with pytest.raises(ValueError):
        quality_classifier.scored(docs, quality_classifier.train(docs, labels))
    assert quality_classifier.predictions(docs.limit(0), labels.limit(0)).count() == 0


def test_classifier_is_accurate_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.predictions(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


# --- quality rules and the mix ------------------------------------------------------------------------------------------


def plain_measures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_measures(spark):
    texts = [None, "", " \n\x0b ", "one", "a b c d e f g h", "a " * 9, "a b c d e f g h i " * 3, "x\ny\nx\n\nx", "#*$%&|<> é　z", "w1 w2 w3 w4 w5 w6 w7 w8 q w1 w2 w3 w4 w5 w6 w7 w8 z", "r s " * 20_000]
    docs = spark.createDataFrame([(i, t, None, "h") for i, t in enumerate(texts)], "doc_id long, text string, source string, host string")
    got = {r.doc_id: r for r in quality_rules.measured(docs).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == plain_measures(t), t
    assert quality_rules.judge(docs).count() == len(texts) and quality_rules.judge(docs.limit(0)).count() == 0


def test_bad_hosts_take_their_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(k, "bad words" if k % 10 else good, "bad") for k in range(60)] + [(100 + k, good if k % 10 else "short", f"good{k % 5}") for k in range(300)] + [(999, good, None)]
    judged = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not judged[0].kept and not judged[0].base_failed and judged[101].kept and not judged[100].kept and judged[999].kept


def plain_strength(hosts):
    """The prior's strength from (rows, failures) of each host, by the definition over all pairs of a host's rows."""
    n = sum(rows for rows, _ in hosts)
    m = sum(bad for _, bad in hosts) / n
    if m in (0, 1):
        return 1000.0
    spread = sum(rows * (bad / rows - m) ** 2 for rows, bad in hosts) / n / (m * (1 - m))
    chance, most = (len(hosts) - 1) / n, 1 - sum((rows / n) ** 2 for rows, _ in hosts)
    r = (spread - chance) / (most - chance) if most != chance else -1
    return min(1000.0, max(1.0, 1 / r - 1)) if r > 0 else 1000.0


@pytest.mark.parametrize("rows", [5, 50, 500])
def test_hosts_that_differ_by_chance_only_are_shrunk_wholly(spark, rows):
    rng = np.random.default_rng(rows)
    hosts = [(int(rows), int(k)) for k in rng.binomial(rows, 0.3, 400)]
    flat = spark.createDataFrame([(str(h), i < bad) for h, (n, bad) in enumerate(hosts) for i in range(n)], "host string, base_failed boolean")
    got = {int(r.host): r.shrunk_rate for r in quality_rules.host_verdicts(flat).collect()}
    k, m = plain_strength(hosts), sum(b for _, b in hosts) / (rows * len(hosts))
    assert k > 5 * rows or k == 1000
    assert all(got[h] == pytest.approx((bad + m * k) / (n + k), abs=1e-9) for h, (n, bad) in enumerate(hosts))


@pytest.mark.parametrize("hosts", [[(60, 54), (60, 6), (5, 0), (1, 1)], [(7, 0)], [(7, 7), (3, 3)], [(1, 1), (1, 0)]])
def test_prior(spark, hosts):
    flat = spark.createDataFrame([(str(h), i < bad) for h, (n, bad) in enumerate(hosts) for i in range(n)], "host string, base_failed boolean")
    k, m = plain_strength(hosts), sum(b for _, b in hosts) / sum(n for n, _ in hosts)
    got = {int(r.host): r.shrunk_rate for r in quality_rules.host_verdicts(flat).collect()}
    assert all(got[h] == pytest.approx((bad + m * k) / (n + k), abs=1e-9) for h, (n, bad) in enumerate(hosts))


def test_the_host_rule_decides_in_sql_too(spark, tmp_path):
    """A table in which whole hosts go: the SQL twin says the same of every document."""
    import duckdb
    from seriesmill.llm import sql

    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, "short" if rate * 10 > i % 10 else good, host) for host, rate, n in (("awful", 0.8, 200), ("bad", 0.6, 60), ("fair", 0.4, 60), ("fine", 0.1, 300), (None, 0.7, 30), ("one", 1.0, 1)) for i in range(n)]
    docs = spark.createDataFrame([(k, t, s) for k, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    want = dict(con.execute(f"select doc_id, kept from ({sql.QUALITY_RULES})").fetchall())
    got = {r.doc_id: (r.kept, r.base_failed) for r in QUERIES["op4_quality_rules"](spark, str(tmp_path)).collect()}
    assert {k: kept for k, (kept, _) in got.items()} == want
    assert sum(not kept and not failed for kept, failed in got.values()) > 50


def test_native_rules_run_no_python(spark):
    import io
    from contextlib import redirect_stdout

    text = io.StringIO()
    with redirect_stdout(text):
        quality_rules.judge(spark.read.parquet(f"{SF}/documents.parquet")).explain()
    assert not any(x in text.getvalue() for x in ("Python", "Pandas", "Arrow"))


def test_an_id_with_most_rows_fills_many_buckets(spark):
    """A third of the rows without doc_id, another third with one: no bucket holds either."""
    mix = mixing.Mix(bucket_rows=100)
    docs = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"), F.lit("s").alias("source"))
    rows = docs.select(F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("at"), "source", mixing.n_words(F.col("text")).alias("size"))
    ordered, _ = mixing.ordered(rows, mix)
    for p in (1, 2):
        share = F.conv(F.substring(f"key{p}", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
        assert ordered.groupBy(F.floor(share * 60)).count().agg(F.max("count")).first()[0] < 400
    plan = mixing.plan(docs, mix)
    assert plan.count() == 6_000 and plan.where("taken > 2 * size").count() == 0
    assert plan.agg(F.sum("taken")).first()[0] == pytest.approx(plan.agg(F.max("target")).first()[0], abs=10)


def test_targets_stop_at_twice_the_size(spark):
    docs = spark.createDataFrame([(i, "w " * 10, s, "t") for i, s in enumerate(["a"] * 5 + ["b"] * 100 + ["c"] * 10 + [None] * 20)], "doc_id long, text string, source string, target string")
    got = {(r.source_size, round(r.target, 6)) for r in mixing.plan(docs).collect()}
    assert {t for s, t in got if s == 50} == {100.0} and {t for s, t in got if s == 100} == {200.0} and {t for s, t in got if s == 200} == {400.0}
    assert sum(t for _, t in got) == pytest.approx(1.5 * 1350)


@pytest.mark.parametrize("bucket_rows", [4_096, 3])
def test_mix_edges(spark, bucket_rows):
    rows = [(1, None, "a"), (None, "x y", "a"), (2, "x y", None), (2, "x y", None), (3, "   ", "zero"), (4, "w " * 500, "b"), *((10 + i, "w " * (i % 7), "c") for i in range(50))]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, size int")
    mix = mixing.Mix(bucket_rows=bucket_rows)
    one, two = (sorted(map(str, mixing.plan(d, mix).collect())) for d in (docs, docs.repartition(5)))
    assert one == two and len(one) == len(rows)
    assert all(r.taken <= 2 * r.size for r in mixing.plan(docs, mix).collect())
    assert mixing.mix_documents(docs, mix).columns == docs.columns
    assert mixing.plan(docs.limit(0)).count() == 0 and mixing.mix_documents(docs.limit(0)).count() == 0
    assert mixing.plan(docs.where(F.col("source") == "zero")).first()["target"] == 0.0


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls in any column, repeated rows, and columns with the names that stages use themselves."""
    long = "word other thing here " * 3_000
    rows = [(1, None, None, None), (None, "some text to keep around", "en", "a"), (2, "", "en", "a"), (2, "", "en", "a"), (3, long, None, "b"), (4, long.upper(), "de", None), (5, " \n ", "en", "a")]
    docs = spark.createDataFrame([(*r, 0, 1, 2, "s") for r in rows], "doc_id long, text string, lang string, source string, at int, fp int, size int, score string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None, 0), (None, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, out, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert out.columns == docs.columns
    found = corpus_pipeline.STAGES[-1][1](spark, out, str(tmp_path)).collect()
    assert found and all(r.n_tokens >= 1 for r in found)


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
