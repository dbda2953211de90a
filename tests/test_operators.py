import math
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gleaner.operators import answer, changes, chunk, embed, evaluate, extract, ordering, prompt, rerank
from gleaner.sources import csv, files, tables
from gleaner.session import stage_path


def test_running_totals_in_blocks_equal_a_plain_window(spark):
    rows = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"), (F.col("id") % 7).alias("v")
    )
    got = ordering.running_totals(rows, ["g"], "id", {"total": F.col("v")}, block_rows=100)
    window = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.withColumn("total", F.sum("v").over(window))
    assert sorted(got.collect()) == sorted(want.select(got.columns).collect())


def test_request_groups_hold_at_most_one_request(spark):
    rows = spark.range(1000).withColumn("source", F.when(F.col("id") < 700, "hot").otherwise("cold"))
    groups = ordering.request_groups(rows, ["source"], "id", 150, block_rows=64).groupBy("source", "batch_no").count()
    sizes = {(r.source, r.batch_no): r["count"] for r in groups.collect()}
    assert sizes == {**{("hot", i): 150 for i in range(4)}, ("hot", 4): 100, ("cold", 0): 150, ("cold", 1): 150}


def test_request_batches_cross_arrow_batches():
    parts = [[1] * 10] * 31
    assert [len(b) for b in embed.request_batches(iter(parts), 150)] == [150, 150, 10]
    assert list(embed.request_batches(iter([]), 150)) == []


def test_user_model(spark):
    rows = spark.range(1000).select("id", F.concat(F.lit("t"), "id").alias("text")).coalesce(1)

    def connect():
        def model(texts):
            assert len(texts) <= 150
            return [[float(t[1:]), float(len(texts))] for t in texts]

        return model

    got = embed.embed_with(rows, "id", "text", connect).toPandas()
    assert (got["embedding"].str[0] == got["id"]).all()
    assert Counter(got["embedding"].str[1]) == {150.0: 900, 100.0: 100}


def test_a_failing_model_fails_the_job(spark):
    rows = spark.range(3).select("id", F.lit("x").alias("text"))
    with pytest.raises(Exception, match="vectors for"):
        embed.embed_with(rows, "id", "text", lambda: lambda texts: []).collect()


def test_text_without_terms_has_a_zero_vector(spark):
    rows = spark.createDataFrame([(1, "..."), (2, "one two")], "key bigint, text string")
    counted = embed.term_counts(rows, "text", width=16)
    model = embed.embedder(embed.fit_weights(counted))
    made = {r.key: r.embedding for r in embed.embed_counts(counted, model).collect()}
    assert set(made[1]) == {0.0} and abs(sum(x * x for x in made[2]) - 1) < 1e-6


def test_split_by_width(spark):
    rows = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, None)], "key bigint, v array<float>")
    good, wrong = embed.split_by_width(rows, "v", 2)
    assert [r.key for r in good.collect()] == [2] and sorted(r.key for r in wrong.collect()) == [1, 3]


def test_one_row_per_key_with_a_hot_key(spark):
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("version"), F.lit("x").alias("t")
    )
    got = changes.latest_per_key(rows, "k", "version")
    assert got.count() == got.select("k").distinct().count() == rows.select("k").distinct().count()
    assert got.where("k = 7").first().version == 897


def test_changes_lead_from_old_to_new(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k bigint, t string")
    new = spark.createDataFrame([(2, "c"), (3, ""), (4, "d")], "k bigint, t string")
    got = {tuple(r) for r in changes.changes_between(old, new, "k", ["t"]).collect()}
    assert got == {
        (1, "delete", "a"), (2, "update_pre", "b"), (2, "update_post", "c"),
        (3, "update_pre", None), (3, "update_post", ""), (4, "insert", "d"),
    }
    assert changes.changes_between(new, new, "k", ["t"]).count() == 0


def test_core_lines(spark):
    common = "all rights reserved here"
    rows = [(i, f"{common}\nbody text number {i}\nIntro ...... 12\nshort\n{common}") for i in range(4)]
    docs = spark.createDataFrame([*rows, (9, "short")], "doc_id bigint, text string")
    got = {r.doc_id: r.lines for r in extract.core_lines(docs, "doc_id", "text", 0.6).collect()}
    assert got == {**{i: [f"body text number {i}"] for i in range(4)}, 9: []}


def test_csv_keeps_hard_fields(spark):
    rows = [("a, \"b\" 'c'", "x\ny", True), ("trailing ", "ﬁne", False)]
    path = stage_path(spark, "csv")
    csv.write_csv(spark.createDataFrame(rows, "question string, ground_truth string, episode_done boolean"), path)
    got = csv.read_csv(spark, path, multi_line=True)
    assert got.schema["episode_done"].dataType.simpleString() == "boolean"
    assert sorted(tuple(r) for r in got.collect()) == sorted(rows)


def test_tables(spark):
    spark.sql("DROP TABLE IF EXISTS t_append")
    tables.create_table(spark, "t_append", "id BIGINT, name STRING", stage_path(spark, "t"))
    rows = spark.createDataFrame([(1, "a")], "id bigint, name string")
    tables.append_rows(rows.select("name", "id"), "t_append")
    tables.create_table(spark, "t_append", "id BIGINT, name STRING")
    assert [tuple(r) for r in spark.table("t_append").collect()] == [(1, "a")]
    with pytest.raises(ValueError):
        tables.append_rows(rows.select("name"), "t_append")


def test_scan_reads_no_bytes_for_lengths(spark, small):
    names = files.scan_files(spark, small, glob="*.parquet").select("path", "length")
    assert names.count() == 14
    assert "content" not in names._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_bm25_by_brute_force(spark):
    texts = {1: "red fox runs", 2: "red red apple", 3: "blue sky over the red sea", 4: "..."}
    corpus = spark.createDataFrame(list(texts.items()), "key bigint, content string")
    asked = "red fox"
    candidates = corpus.select(F.lit(1).cast("bigint").alias("query_id"), "key", F.lit(asked).alias("question"), "content")
    docs = {k: [w for w in t.split() if w.isalpha()] for k, t in texts.items()}
    mean = sum(map(len, docs.values())) / 4
    got = rerank.bm25_scores(candidates, rerank.term_frequencies(corpus, "content"), 4, mean)
    for row in got.collect():
        score = 0.0
        for term in asked.split():
            df, tf = sum(term in d for d in docs.values()), docs[row.key].count(term)
            idf = math.log(1 + (4 - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(docs[row.key]) / mean))
        assert row.bm25 == pytest.approx(score, abs=1e-6)


def test_user_ranker_and_order_changes(spark):
    rows = [(1, 10, 1, "q", "bb"), (1, 11, 2, "q", "a"), (2, 12, 1, "q", "a"), (2, 13, 2, "q", "bb")]
    first = spark.createDataFrame(rows, "query_id bigint, key bigint, rank int, question string, content string")
    scored = rerank.score_with(first, lambda: lambda q, t: [-float(len(x)) for x in t])
    moved = rerank.order_changes(first, rerank.best_of(scored, "score", None)).collect()
    assert {(r.query_id, r.key, r.rank_delta, r.query_changed) for r in moved} == {
        (1, 10, -1, True), (1, 11, 1, True), (2, 12, 0, False), (2, 13, 0, False),
    }


def test_prompt_does_not_fill_twice(spark):
    rows = spark.createDataFrame([("see {question} and {context}", "why?")], "c string, q string")
    text = rows.select(prompt.filled(F.col("c"), F.col("q")).alias("p")).first().p
    assert "see {question} and {context}" in text and text.count("why?") == 1


def test_stuffing_with_a_budget(spark):
    rows = spark.createDataFrame([(["a b", "c d e", "f"],)], "c array<string>")
    got = rows.select(*[prompt.stuffed(F.col("c"), b).alias(str(b)) for b in (1, 2, 4, 5, 6)]).first()
    assert list(got) == ["", "a b", "a b", "a b\nc d e", "a b\nc d e\nf"]


def test_refusal(spark):
    rows = spark.createDataFrame([("x", 0.5), ("x", 0.1), (None, None)], "a string, s double")
    got = rows.select(prompt.guarded(F.col("a"), F.col("s"), 0.3).alias("r")).collect()
    assert [r.r for r in got] == ["x", prompt.REFUSAL, prompt.REFUSAL]


def test_chat_history_of_a_long_conversation(spark):
    turns = [(1, t, "user", " ".join(["w"] * (1 + t * 7 % 5))) for t in range(300)]
    turns += [(2, t, "user", "" if t else "a b") for t in range(3)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): r for r in prompt.chat_history(df, 12, block_rows=40).collect()}
    assert len(got) == len(turns)
    for conv, turn, *_ in turns:
        want, room = [], 12
        for earlier in reversed([t for t in turns if t[0] == conv and t[1] < turn]):
            size = max(len(earlier[3].split()), 1)
            if size > room:
                break
            room -= size
            want.insert(0, f"user: {earlier[3]}")
        row = got[conv, turn]
        assert (row.n_history, row.history_tokens, row.history) == (len(want), 12 - room, "\n".join(want))


def test_whole_history_as_rows(spark):
    turns = spark.createDataFrame([(1, t, "user", str(t)) for t in range(40)] + [(2, 5, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.turn, r.earlier_turn, r.text) for r in prompt.chat_history_rows(turns).collect())
    assert got == [(t, e, str(e)) for t in range(40) for e in range(t)]


def test_overlap_is_found_whatever_its_length(spark):
    lists = [["a b c d", "b c d e", "x", "x x", "x x y"]]
    got = spark.createDataFrame([(1, c) for c in lists], "doc_id bigint, chunks array<string>")
    assert [r.shared_words for r in chunk.neighbour_overlap(got, "doc_id").orderBy("chunk_no").collect()] == [3, 0, 1, 2]


def test_one_row_per_key(spark):
    rows = [(1, "old", 1), (1, "new", 2), (1, "new", 2), (2, None, None), (None, "n", 3), (None, "m", 4)]
    df = spark.createDataFrame(rows, "k bigint, t string, v int")
    got = {(r.k, r.t) for r in changes.latest_per_key(df, "k", "v").collect()}
    assert got == {(1, "new"), (2, None), (None, "m")}


def test_answers_and_grounding(spark):
    rows = spark.createDataFrame(
        [(1, "what is a fox", ["Cats sleep. A fox is red.", "The fox runs."]), (2, "none", [])],
        "query_id bigint, q string, c array<string>",
    )
    best = answer.best_sentence(rows, "q", "c").withColumn("t", prompt.stuffed(F.col("c")))
    lead = answer.lead_sentence(rows, "c")
    assert [r.answer for r in best.orderBy("query_id").collect()] == ["A fox is red.", ""]
    assert [r.answer for r in lead.orderBy("query_id").collect()] == ["Cats sleep.", ""]
    made_up = best.withColumn("answer", F.lit("A fox is red. Dogs bark."))
    row = answer.grounding(made_up, "answer", "t").orderBy("query_id").first()
    assert row.unsupported == ["Dogs bark."] and row.supported_share == pytest.approx(4 / 6, abs=1e-6)
    asked = answer.answer_with(rows.select("query_id", F.col("q").alias("prompt")), lambda: lambda p: [x[::-1] for x in p])
    assert {r.query_id: r.answer for r in asked.collect()} == {1: "xof a si tahw", 2: "enon"}


def test_scores(spark):
    rows = spark.createDataFrame(
        [(1, "a b", "a a b", ["b"], "a b c", "x"), (2, "q", None, None, "t", "y"), (3, "q", "", [], "", "y")],
        "query_id bigint, inputs string, answer string, context array<string>, ground_truth string, kind string",
    )
    scored = {r.query_id: r for r in evaluate.scored_rows(rows).collect()}
    assert (scored[1].precision, scored[1].recall) == (0.666667, 0.666667)
    assert (scored[2].f1, scored[3].f1, scored[3].answer_relevance) == (0.0, 0.0, 0.0)
    assert (scored[1].answer_relevance, scored[1].context_relevance) == (1.0, 0.5)
    rolled = evaluate.totals(evaluate.scored_rows(rows), ["f1"], ["kind"], rollup=True).collect()
    assert {(r.kind, r.n_rows) for r in rolled} == {("x", 1), ("y", 2), (None, 3)}
    judged = evaluate.judge_with(rows, lambda: lambda f: [float(len(t)) for t in f["ground_truth"]])
    assert {r.query_id: r.score for r in judged.collect()} == {1: 5.0, 2: 1.0, 3: 0.0}
