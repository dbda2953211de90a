"""Packing, training order, chat, urls, languages and archives."""

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import chat, langid, packing, queries, token_output, tokens, urls, warc
from gleaner.session import ship_package, stage_path

TEXTS = [None, "", "a", "<|endoftext|> it's  we'll\n\n x", "naïve über 漢字 😀", "\u200b\u00a0 \u2028 ’s", "word " * 3000, "ab" * 3000, *(f"some text number {i} " * (i % 40 + 1) for i in range(150))]


@pytest.fixture(scope="module")
def docs(spark):
    ship_package(spark)
    data = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again"), (None, "no id", "x")]
    return spark.createDataFrame(data, "doc_id bigint, text string, ids string")


def exact_ids(text):
    own = tokens.encoder(tokens.Vocabulary.byte_bpe_50k())
    return [*own.exact.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_ids_are_those_of_the_tokenizer():
    own = tokens.encoder(tokens.Vocabulary.byte_bpe_50k())
    rng = random.Random(2)
    alphabet = [*"abcdef'  \n\tstrvmld.,!?0123éßÑ\u00a0\u0085\u1680\u3000漢<|", "<|endoftext|>", "'ll", "'s", "\r\n"]
    for text in [*TEXTS, *("".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(3000))]:
        assert own.ids(text).tolist() == exact_ids(text)


def test_pieces(docs):
    found = packing.pack(docs, shard_ids=20_000).collect()
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
        assert np.frombuffer(r.ids, "<u2").size == r.length and crc(np.frombuffer(r.ids, "<u2")) == r.ids_crc32
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 1024
        padding += 1024 - at
    for name, text in [*enumerate(TEXTS), (None, "no id")]:
        want = exact_ids(text)
        pieces = sorted(by_doc[name], key=lambda r: r.start)
        if name == 3:
            assert sum(r.length for r in pieces) == 2 * len(want)
            continue
        assert b"".join(r.ids for r in pieces) == np.array(want, "<u2").tobytes()
        assert {r.doc_tokens for r in pieces} == {len(want)}
    assert packing.pack(docs.limit(0)).count() == 0


def test_neighbours_are_the_best_by_bm25():
    rng = np.random.default_rng(4)
    arrays = [rng.integers(0, 60, rng.integers(5, 90)).astype("<u2") for _ in range(80)]
    frequencies = np.zeros(60)
    for x in arrays:
        frequencies[np.unique(x)] += 1
    idf = np.log1p((len(arrays) - frequencies + 0.5) / (frequencies + 0.5))
    mean = sum(map(len, arrays)) / len(arrays)
    shard = packing.Shard(arrays, idf, mean)

    def score(seed, doc):
        total = 0.0
        for t in set(arrays[seed].tolist()):
            tf = int((arrays[doc] == t).sum())
            total += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(arrays[doc]) / mean))
        return total

    length, sizes = 200, [len(x) for x in arrays]
    packer = packing.Packer(length, 0)
    used, filled, seed, choices = set(), 0, None, 0
    for doc, _ in packer.order(shard, sizes):
        if filled and seed is not None:
            best = max(score(seed, d) for d in range(len(arrays)) if d not in used)
            assert score(seed, doc) == pytest.approx(best, rel=1e-4)
            choices += 1
        used.add(doc)
        if seed is None or filled == 0 or filled + sizes[doc] >= length:
            seed = doc
        filled = (filled + sizes[doc]) % length
    assert len(used) == 80 and choices > 30


def test_permutation():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        p = token_output.Permutation(n, 7)
        slots = p.slots(np.arange(n))
        assert sorted(slots.tolist()) == list(range(n)) and p.indices(slots).tolist() == list(range(n))
    other = token_output.Permutation(1000, 8).slots(np.arange(1000))
    assert not np.array_equal(other, token_output.Permutation(1000, 7).slots(np.arange(1000)))


def test_training_order(spark, docs):
    path = stage_path(spark, "order")
    n = token_output.write_training_order(docs, path, length=64, per_shard=16)
    held = {r.slot: r for r in spark.read.parquet(f"{path}/manifest").collect()}
    written = {r.slot: r for r in token_output.read_training_order(spark, path, length=64, per_shard=16).collect()}
    assert sorted(held) == sorted(written) == list(range(n))
    order = token_output.Permutation(n, token_output.KEY)
    parts = {}
    for slot, r in written.items():
        assert (r.shard, r.byte_offset) == (slot // 16, slot % 16 * 129)
        assert held[slot]["index"] == order.indices(np.array([slot]))[0]
        at, ids = 0, np.frombuffer(r.ids, "<u2")
        for p in held[slot].pieces:
            parts.setdefault(p.doc_id, []).append((p.start, ids[at : at + p.length].tobytes()))
            at += p.length
        assert at == held[slot].n_ids and not ids[at:].any()
    for name, text in [*enumerate(TEXTS), (None, "no id")]:
        if name != 3:
            assert b"".join(x for _, x in sorted(parts[name])) == np.array(exact_ids(text), "<u2").tobytes()
    late = token_output.read_training_order(spark, path, first_slot=n - 5, length=64, per_shard=16)
    assert {r.slot: r.ids for r in late.collect()} == {s: written[s].ids for s in range(n - 5, n)}
    empty = stage_path(spark, "order")
    assert token_output.write_training_order(docs.limit(0), empty) == 0
    assert token_output.read_training_order(spark, empty).count() == 0


HARD = ["\\### Assistant: </turn> ok", "", None, "</turn>\n<turn role=\"user\">\n", "\\", "\\\\<", "a\nb\\n", "😀<é>", 'say "x"']


def test_chat_round_trip(spark):
    ship_package(spark)
    rng = random.Random(0)
    data = [(c, t, rng.choice(["user", "assistant", "system", 'odd"\\<role', None]), rng.choice(HARD)) for c in range(30) for t in range(rng.randrange(1, 12))]
    rows = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string").withColumn("node", F.lit("clash"))
    got = chat.read_back(chat.format_paths(chat.choose_paths(chat.turns_as_tree(rows))))
    assert {r.conv_id: tuple(r)[1:5] for r in got.collect()} == brute.chats(data)
    assert chat.read_back(chat.format_paths(chat.choose_paths(chat.turns_as_tree(rows.limit(0))))).count() == 0


def test_best_branches(spark):
    #          0 - 1 - 2        scores: node 2 leads to mean 2, node 4 to mean 3, node 5 ties with 4
    #           \ 3 - 4, 5      6 hangs on nothing, 7 and 8 on each other, 9 has no parent row
    data = [(1, 0, None, 1.0), (1, 1, 0, 2.0), (1, 2, 1, 3.0), (1, 3, 0, 3.0), (1, 4, 3, 5.0), (1, 5, 3, 5.0), (1, 7, 8, 9.0), (1, 8, 7, 9.0), (1, 9, 77, 0.5), (1, 9, 77, 0.5), (2, 0, None, None)]
    rows = spark.createDataFrame([(*x, "user", f"t{x[1]}") for x in data], "conv_id bigint, node bigint, parent bigint, score double, role string, text string")
    paths = {}
    for r in chat.choose_paths(rows, branches=4).collect():
        paths.setdefault((r.conv_id, r.branch), []).append((r.depth, r.text))
    texts = {k: [t for _, t in sorted(v)] for k, v in paths.items()}
    assert texts == {(1, 1): ["t0", "t3", "t4"], (1, 2): ["t0", "t3", "t5"], (1, 3): ["t0", "t1", "t2"], (1, 4): ["t9"], (2, 1): ["t0"]}


def test_long_thread(spark):
    rows = spark.range(700).select(F.lit(5).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    got = chat.read_back(chat.format_paths(chat.choose_paths(chat.turns_as_tree(rows)))).collect()
    assert [(r.n_turns, r.loss_sha256) for r in got] == [(700, brute.sha("".join(map(str, range(700)))))]


def brute_rule(host, path):
    best = None
    for h, p, v in queries.URL_RULES:
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h + p), h + p, v))
    return best[1:] if best else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?q=1#f", "http://example.net", "https://net/", "http://x.net/EN/", "http://notexample.net/en/",
    "ftp://example.com/de/", "http://example.com:80/de/", "http://a.b.c.example.com/de/1", "http://example.org/fr/?a", "http://org/fr/", "http://ÄA.com/x", "http://x.com?y/z", "http://x.com#y://a.net/",
    "a://b://c.net/", "http://example.net/en/", "http://user@example.net/en/",
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(URLS)] + [(0, None, None, "x")], "page_id bigint, url string, html string, rule string")
    got = urls.judge_pages(pages, urls.rule_table(spark, queries.URL_RULES)).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        url = URLS[r.page_id]
        after = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([after.find(c) for c in "/?#" if c in after] or [len(after)])
        host = after[:cut].translate(brute.UPPER)
        rest = after[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
        rule, verdict = brute_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or "allow")
    assert urls.judge_pages(pages.limit(0), urls.rule_table(spark, [])).count() == 0


def test_aliases_take_the_block(spark):
    link = '<html><head><LINK href="{}" rel="canonical"></head>'
    pages = spark.createDataFrame(
        [
            (1, "http://plain.com/a?utm_source=x", None), (2, "https://www.plain.com/a/", link.format("http://bad.net/z")), (3, "http://bad.net/z", "no links"),
            (4, "http://other.com/", '<meta http-equiv="refresh" content="0; url=http://example.net/en/ok">'), (5, "http://third.com/", link.format("/relative")),
            (6, "http://mixed.com/", link.format("http://other.com/")), (7, "http://mixed.com/", link.format("http://bad.net/y")), (8, "http://far.com/", None),
        ],
        "page_id bigint, url string, html string",
    )
    moved = spark.createDataFrame([("http://far.com/", "http://near.com/"), ("http://near.com/", "http://bad.net/z"), (None, "http://x.com/")], "src string, dst string")
    got = {r.page_id: r.verdict for r in urls.judge_pages(pages, urls.rule_table(spark, queries.URL_RULES), moved).collect()}
    # 4, 6 and 7 are one group with an allowed url; 3 is blocked by its own rule.
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block"}


def test_archive(spark):
    ship_package(spark)
    big, small_one = "x" * 1000 + "é\r\n\r\nWARC/1.1\r\n", "y" * 999
    data = [(i, f"http://h/{i}\r\nX: y" if i % 2 else None, h) for i, h in enumerate([big, big, small_one, small_one, None, "", "z" * 5000, big])] + [(6, "again", "z" * 5000)]
    pages = spark.createDataFrame([(*x, "clash") for x in data], "page_id bigint, url string, html string, payload string")
    path = stage_path(spark, "warc")
    warc.write_archive(pages, path, "page_id", "url", "html")
    got = warc.read_archive(spark, path).collect()
    name = lambda x: int(x) if x is not None else None
    assert sorted((int(r.id), r.payload_bytes, r.payload_digest, r.record_type, name(r.refers_to)) for r in got) == sorted(brute.archive([(i, h) for i, _, h in data]))
    assert all(bytes(r.payload) == (data[int(r.id)][2] or "").encode() for r in got)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    out = stage_path(spark, "warc-files")
    warc.export_warc(spark, path, out)
    records = [x for f in spark.read.format("binaryFile").load(out).collect() for x in warc.records_in_file(bytes(f.content))]
    assert len(records) == len(data)
    assert sorted(len(block.split(b"\r\n\r\n", 1)[1]) for _, block in records) == sorted([0, 0, 0, 0, 999, 999, 5000, 5000, len(big.encode())])
    empty = stage_path(spark, "warc")
    warc.write_archive(pages.limit(0), empty, "page_id", "url", "html")
    assert warc.read_archive(spark, empty).count() == 0


def test_changed_payload_is_noticed(spark):
    path = stage_path(spark, "warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string"), path, "page_id", "url", "html")
    headers = spark.read.parquet(f"{path}/headers")
    headers.select("address", F.encode(F.lit("other"), "UTF-8").alias("payload")).write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="missing or was changed"):
        warc.read_archive(spark, path).collect()


def test_languages(spark, small):
    ship_package(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id"))))
    assert model.languages == ["de", "en", "es", "fr"]
    found = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(langid.held_out(F.col("doc_id"))).collect()
    right = sum(r.lang_pred == r.lang for r in found)
    assert len(found) > 200 and right / len(found) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_language_spans_and_edges(spark):
    en, de, ru = "the quick brown fox and the dog with that thing ", "der schnelle braune fuchs und ein hund mit dem ding ", "быстрая лиса и ленивая собака "
    labelled = spark.createDataFrame([(1, en * 5, "en"), (2, de * 5, "de"), (3, ru * 5, "ru"), (4, None, "en"), (5, "x", None)], "doc_id bigint, text string, lang string")
    model = langid.fit(labelled)
    docs = spark.createDataFrame([(1, en), (2, de * 3 + en * 3 + ru), (3, None), (4, "12 %"), (5, ""), (6, "лиса"), (7, "漢"), (7, "漢")], "doc_id bigint, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    assert got[1][0] == "en" and got[2][0] == "de" and got[6][0] == "ru"
    assert got[3] == got[4] == got[5] == ("und", 0.0) and got[7][0] in model.languages
    spans = {r.doc_id: [(s.lang, s.end - s.first) for s in r.spans] for r in langid.label_spans(docs, model).collect()}
    assert spans[2] == [("de", 30), ("en", 30), ("ru", 5)] and spans[3] == []
    nothing = langid.fit(labelled.limit(0))
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).count() == 0


def test_viterbi_against_all_labellings():
    from itertools import product

    rng = np.random.default_rng(1)
    first = np.array([0, 1, 1, 6, 10])
    scores = rng.normal(0, 3, (10, 3)).astype(np.float32)
    got = langid.viterbi(scores, first, 2.0)
    for a, b in zip(first, first[1:]):
        value = lambda path: sum(scores[a + i, p] for i, p in enumerate(path)) - 2.0 * sum(x != y for x, y in zip(path, path[1:]))
        if b > a:
            best = max(product(range(3), repeat=int(b - a)), key=value)
            assert value(tuple(got[a:b])) == pytest.approx(value(best), rel=1e-5)


def test_more_than_127_languages_and_long_texts(spark):
    """Labels are wide enough, and training reads whole texts: what tells a language stands behind 20,000 characters."""
    ship_package(spark)
    letters = "abcdefghijklmnopqrst"
    words = {f"l{i:03d}": "".join(letters[(i // 20 ** k) % 20] for k in range(2)) * 3 for i in range(200)}
    rows = [(i, ("zz " * 8000 if i == 150 else "") + " ".join([w] * 200), name) for i, (name, w) in enumerate(words.items())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    asked = spark.createDataFrame([(i, " ".join([w] * 50)) for i, w in enumerate(words.values())], "doc_id bigint, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(asked, model).collect()}
    assert got == {i: name for i, name in enumerate(words)}
