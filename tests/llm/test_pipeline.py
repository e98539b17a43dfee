import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from corridor.llm import langid, ngram_join
from corridor.llm.storage import table
from tests.conftest import SF_SMALL
from tests.llm.test_bpe import encoded
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_ngram_join import brute as groups


def test_stages_follow_each_other(spark):
    docs = table(spark, SF_SMALL, "documents")
    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "private_data", "bpe_tokens"]
    rows = {r.doc_id: r for r in docs.collect()}

    one = P.language_id(spark, docs, SF_SMALL)
    assert one.schema == docs.schema
    model = langid.train(docs)
    kept = sorted(r.doc_id for r in one.collect())
    assert kept == sorted(d for d, r in rows.items() if (p := model.judge(r.text))[0] != "und" and p[2] >= P.MIN_KNOWN)
    assert len(kept) >= 0.95 * len(rows)

    two = P.near_duplicates(spark, one, SF_SMALL)
    assert two.schema == docs.schema
    kept = sorted(r.doc_id for r in two.collect())
    assert kept == sorted(d for d, _, c in groups([(d, rows[d].text) for d in sorted(r.doc_id for r in one.collect())]) if d == c)

    three = P.decontamination(spark, two, SF_SMALL)
    assert three.schema == docs.schema
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    clean = {d for d, _, n, *_ in hits([(d, rows[d].text) for d in kept], items) if not n}
    assert {r.doc_id for r in three.collect()} == clean

    four = P.private_data(spark, three, SF_SMALL)
    assert four.columns == docs.columns and [f.dataType for f in four.schema] == [f.dataType for f in docs.schema]
    texts = {r.doc_id: r for r in four.collect()}
    assert set(texts) == clean and all(r.n_chars == len(r.text) for r in texts.values())

    five = P.bpe_tokens(spark, four, SF_SMALL).collect()
    want = dict(zip(texts, encoded([r.text for r in texts.values()])))
    assert {r.doc_id: r.ids for r in five} == want and all(r.n_tokens == len(r.ids) for r in five)


def test_run_equals_the_stages(spark):
    got = P.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids"] and got.count() > 0
    assert P.ORACLE_SQL is None


def test_stages_take_nulls_empty_tables_and_extra_columns(spark):
    rng = random.Random(1)
    base = [(i, " ".join(rng.choices(["the", "house", "and", "water", f"n{i}"], k=30)), "en", "s", 1, "x", 5) for i in range(40)]
    base += [(None, None, None, None, None, None, None), (50, "", None, None, None, None, None), (51, base[0][1], "en", "s", 1, "x", 5)]
    df = spark.createDataFrame(base, "doc_id long, text string, lang string, source string, n_chars long, score string, set_key int")
    for docs in (df, df.limit(0)):
        for name, stage in P.STAGES:
            docs = stage(spark, docs, SF_SMALL)
            rows = docs.collect()
            if name != "bpe_tokens":
                assert docs.columns == df.columns
        assert all(r.doc_id != 51 for r in rows)


def test_one_document_of_each_group_stays(spark):
    rows = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "z y x w v u"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in P.near_duplicates(spark, df, SF_SMALL).collect()) == [1, 3, 4]
    assert ngram_join.link_components(df).where("component_id = 1").count() == 3


def stage(name):
    return dict(P.STAGES)[name]


def test_rows_are_told_apart_by_their_texts(spark):
    item = max((r.text for r in table(spark, SF_SMALL, "benchmark").collect()), key=len)
    clean = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(4)]
    rows = [(None, item), (None, clean[0]), (7, item), (7, clean[1]), (8, clean[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = stage("decontamination")(spark, df, SF_SMALL).collect()
    assert sorted((r.doc_id or 0, r.text) for r in left) == sorted([(0, clean[0]), (7, clean[1]), (8, clean[2])])
    t, other, third = clean[0], clean[1], clean[2]
    rows = [(3, t), (5, t), (5, other), (9, third), (None, third), (None, clean[3]), (None, clean[3]), (6, None), (6, None), (7, ""), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = stage("near_duplicates")(spark, df, SF_SMALL).collect()
    assert sorted(((r.doc_id or 0, r.text or "") for r in left)) == sorted(
        [(3, t), (5, other), (9, third), (0, clean[3]), (6, ""), (7, ""), (8, "")])


def test_columns_of_any_name(spark):
    names = ["doc_id", "text", "n_chars", "stays", "hit", "again", "language", "_language", "n_entities", "kinds", "known", "at", "row",
             "none", "a.b", "set_key", "component_id", "_Known", "found", "body"]
    texts = [f"the water and the house {i} mail me at x{i}@example.org " + " ".join(f"v{i}y{j}" for j in range(20)) for i in range(6)]
    rows = [(i, texts[i // 2], 1, *[f"{c}{i}" for c in names[3:]]) for i in range(12)] + [(2, texts[1], 1, *names[3:])]
    schema = ", ".join(f"`{c}` {'long' if c in ('doc_id', 'n_chars') else 'string'}" for c in names)
    lang = spark.createDataFrame(rows, schema).withColumn("lang", F.lit("en"))
    for name, run in P.STAGES[:-1]:
        out = run(spark, lang, SF_SMALL)
        assert out.columns == lang.columns, name
        got = {r.doc_id: r for r in out.collect()}
        assert len(got) == (6 if name == "near_duplicates" else 12), name
        assert all(r["a.b"] in (f"a.b{i}", "a.b") and r["kinds"] in (f"kinds{i}", "kinds") for i, r in got.items())
    assert P.bpe_tokens(spark, lang, SF_SMALL).count() == 13


def test_other_languages_go_however_many_were_learned(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang")
    foreign = ["Съешь же ещё этих мягких французских булок да выпей чаю", "这是一个中文句子用来测试语言识别", "xqzvk jwpfh zzkqx vvwxq kjhgf",
               "Zażółć gęślą jaźń, proszę państwa"]
    more = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(foreign)], "doc_id long, text string, lang string")
    for langs in (["en"], ["en", "de"], ["en", "de", "fr", "es"]):
        some = docs.where(F.col("lang").isin(langs)).unionByName(more)
        left = P.language_id(spark, some, SF_SMALL)
        assert left.where("doc_id >= 1000000").count() == 0
        assert left.count() >= 0.97 * docs.where(F.col("lang").isin(langs)).count()
