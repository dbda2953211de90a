import pytest
from pyspark.sql import functions as F

from gleaner import session
from gleaner.functions import text as tx
from gleaner.operators import chunk, extract


def one(spark, value, column, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(column(F.col("x")).alias("r")).first().r


@pytest.mark.parametrize(
    "raw, joined, spaced",
    [
        ("foo\nbar", "foobar", "foo bar"),
        ("end .\nNext  .", "end.Next .", "end. Next ."),
        ("", "", ""),
        ("a. b", "a. b", "a. b"),
    ],
)
def test_clean_section(spark, raw, joined, spaced):
    assert one(spark, raw, tx.clean_section) == joined
    assert one(spark, raw, lambda c: tx.clean_section(c, keep_space=True)) == spaced


def test_sections_are_cleaned_one_by_one(spark):
    assert one(spark, ["a\nb .", "c ."], tx.join_sections, "x array<string>") == "ab.\nc."


def test_terms_know_other_scripts(spark):
    assert one(spark, "Die Größe: ﬁne-tuning, 2x!", tx.terms) == ["die", "größe", "ﬁne", "tuning", "2x"]


def test_sentences(spark):
    assert one(spark, "One. Two!  Three? four", tx.sentences) == ["One.", "Two!", "Three?", "four"]
    assert one(spark, "   ", tx.sentences) == []


@pytest.mark.parametrize("name", ["", "a", "odl_user_123", "Zoë", "日本"])
def test_name_bucket(spark, name):
    assert one(spark, name, tx.name_bucket) == sum(ord(c) for c in name) % 9 + 1


def test_bytes_that_are_not_utf8(spark):
    got = one(spark, bytearray(b"ok \xff ."), lambda c: extract.decoded(c), "x binary")
    assert got.startswith("ok ") and got.endswith(" .")


def test_html(spark):
    page = "<title>T</title><script>var a='<p>';</script><p>One &amp; <b>two</b> .</p><li>three"
    assert one(spark, page, extract.html_text) == "T\nOne & two.\nthree"


def test_user_parser_runs_once_per_task(spark):
    raw = spark.createDataFrame([("a", bytearray(b"x|y .")), ("b", bytearray(b""))], "path string, content binary")

    def parser():
        calls = []
        return lambda data: calls.append(1) or data.decode().split("|")

    rows = {r.path: r.text for r in extract.extract_with(raw, "path", "content", parser).collect()}
    assert rows == {"a": "x\ny.", "b": ""}


def chunks_of(spark, text, fn, **options):
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    return fn(df, "text", **options).first().chunks


@pytest.mark.parametrize("fn", [chunk.window_chunks, chunk.packed_chunks])
@pytest.mark.parametrize("text", ["", "   \n "])
def test_no_words_no_chunks(spark, fn, text):
    assert chunks_of(spark, text, fn) == []
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert chunk.chunk_rows(fn(df, "text"), "doc_id").count() == 0


@pytest.mark.parametrize("n", [1, 9, 10, 11, 18, 19, 100])
def test_windows_by_brute_force(spark, n):
    words = [f"w{i}" for i in range(n)]
    got = chunks_of(spark, " ".join(words), chunk.window_chunks, size=10, overlap=2)
    want, start = [], 0
    while True:
        want.append(" ".join(words[start : start + 10]))
        if start + 10 >= n:
            break
        start += 8
    assert got == want


def pack(sentence_lengths, size, overlap):
    """Plain packing of sentences given by their lengths: lists of (sentence, word) pairs."""
    units = []
    for s, n in enumerate(sentence_lengths):
        words = [f"s{s}w{w}" for w in range(n)]
        units += [words[i : i + overlap] for i in range(0, n, overlap)] if n > size else [words]
    chunks, current = [], []
    for unit in units:
        if sum(map(len, current)) + len(unit) > size:
            chunks.append(current)
            kept, room = [], min(overlap, size - len(unit))
            for earlier in reversed(current):
                if sum(map(len, kept)) + len(earlier) > room:
                    break
                kept.insert(0, earlier)
            current = kept
        current = [*current, unit]
    return [[w for u in c for w in u] for c in [*chunks, current]]


@pytest.mark.parametrize("lengths", [[3], [4, 4, 4, 4], [1] * 40, [25], [2, 30, 1, 9, 10, 3, 3], [10, 10, 10]])
def test_packing_by_brute_force(spark, lengths):
    text = " ".join(" ".join(f"s{s}w{w}" for w in range(n)) + "." for s, n in enumerate(lengths))
    got = chunks_of(spark, text, chunk.packed_chunks, size=10, overlap=3)
    assert [[w.rstrip(".") for w in c.split()] for c in got] == pack(lengths, 10, 3)


def test_packing_keeps_every_sentence_in_budget(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    packed = chunk.packed_chunks(docs, "text")
    rows = packed.select(
        F.array_max(F.transform("chunks", tx.token_count)).alias("longest"),
        F.size(
            F.array_except(tx.words(F.col("text")), F.flatten(F.transform("chunks", tx.words)))
        ).alias("lost"),
    ).agg(F.max("longest"), F.sum("lost")).first()
    assert rows[0] <= tx.CHUNK_SIZE and rows[1] == 0


def test_stage_path_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Conf:
        values = {}

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.stage_path(Session(), "x")
    Conf.values["spark.checkpoint.dir"] = "hdfs://shared/work"
    assert session.stage_path(Session(), "x").startswith("hdfs://shared/work/x-")
