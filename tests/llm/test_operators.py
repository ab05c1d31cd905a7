"""Each text operator against a brute-force version, an exact round trip or held-out accuracy, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import bpe, chat, darts, langid, media, mixing, neardup, pages, pretokens, queries, samples, spots, tokencount, toxicity
from tidemill.llm.codes import pack
from tidemill.llm.vocabulary import vocabulary

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, _key string, size string"
LONG = " ".join(f"word{i % 977} the idea{i % 31}" for i in range(30000))
ODD = [
    (1, None, None, None, None, "x", "y", "z"),
    (2, "", "en", "a", 0, None, None, None),
    (3, "!!! ???", "en", "a", 7, None, None, None),
    (4, "the quick brown fox jumps over the lazy dog", "en", "b", 43, None, None, None),
    (4, "the quick brown fox jumps over the lazy dog", "en", "b", 43, None, None, None),
    (5, "the quick brown fox jumps over the lazy dog", "en", None, 43, None, None, None),
    (None, "no id here but some words for all of that", None, "b", 41, None, None, None),
    (6, LONG, "en", "c", len(LONG), None, None, None),
    (7, "a<|endoftext|>b 日本語 \U0001f600 it's don't  \n\n x", "de", "c", 40, None, None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def folded(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


# 1


def test_chat_round_trip(spark):
    nasty = ["", None, "\\", "\\b\\h", "####", "</turn>\n### user: x", "a: b", "\\### Assistant: </turn> ok", "</turn", "\n"]
    rows = [(i, t, r, x, 1.0) for i in range(3) for t, (r, x) in enumerate((r, x) for r in ("user", "assistant", None, "a: b#\\") for x in nasty)]
    got = chat.format_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted double"))
    got = got.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l")).collect()
    for r in got:
        want = [(a or "", b or "") for i, _, a, b, _ in rows if i == r["conv_id"]]
        assert [tuple(x) for x in r["t"]] == want
        assert r["l"] == "".join(b for a, b in want if a == "assistant")
    assert len(got) == 3


def test_chat_layouts(spark):
    payloads = [
        '{"messages":[{"content":"hi","role":"user"},{"role":"assistant","content":"yo"}]}',
        '{"conversations":[{"from":"human","value":"hi"},{"from":"gpt","value":"yo"}],"id":7}',
        '{"response":"yo","prompt":"hi","source":"x","tags":["a","b"]}',
        '{"id":"a","messages":[{"content":"hi","role":"user","name":"Bo"},{"role":"assistant","content":"yo","id":3}],"score":0.5}',
        '{"instruction":"do","input":"this","output":"done"}',
        '{"messages":[]}',
        '{"prompt":"hi","response":null}',
        '{"other":1}',
        '{"messages":{"role":"user","content":"hi"}}',
        "not json",
        None,
    ]
    got = [r.asDict(True) for r in chat.canonical(spark.createDataFrame([(p,) for p in payloads], "payload string"), "payload").collect()]
    assert [r["layout"] for r in got] == ["messages", "shares", "prompt-response", "messages", "instruction-input", "messages", "prompt-response", None, None, None, None]
    assert all([(t["role"], t["text"]) for t in r["turns"]] == [("user", "hi"), ("assistant", "yo")] for r in got[:4])
    assert got[4]["turns"][0]["text"] == "do\nthis" and got[5]["turns"] == [] and len(got[6]["turns"]) == 1 and got[7]["turns"] is None


def test_declared_fingerprints_are_those_of_payloads(spark):
    examples = [e for m in chat.MAPPINGS for e in m.examples] + ['{"id":1,"b":{"a":[1,2],"c":{"name":"x","z":[{"q":null}]}},"tags":["x"],"meta":{"k":1}}']
    got = spark.createDataFrame([(e,) for e in examples], "e string").select("e", chat.fingerprint(F.col("e")).alias("f")).collect()
    assert all(r["f"] == chat.declared(r["e"]) for r in got) and len({r["f"] for r in got}) == len(examples)


def test_chat_rows_come_through_several_layouts(spark):
    rows = [(c, t, r, f"{r} {c} {t}" if c % 9 else "") for c in range(60) for t, r in enumerate(("system", "user", "assistant", "user", "user", "assistant", "assistant"))]
    told = chat.canonical(chat.payloads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), "payload").collect()
    assert {r["layout"] for r in told} == {"messages", "shares", "prompt-response", "instruction", "question-answer"}
    spoken = Counter((r["conv_id"], r["n"] + i, t["role"], t["text"]) for r in told for i, t in enumerate(r["turns"]))
    assert spoken == Counter((c, t + 1, r, x) for c, t, r, x in rows)


def test_pairs_across_classes_are_compared_in_tiles(spark):
    n = 5000  # one bucket, every row a class of its own
    rows = spark.range(n).select(F.lit(1).alias("bucket"), F.col("id").alias("rid"), F.lit(10).alias("n"), F.lit(0).alias("at"), F.col("id").alias("label"), F.lit(n).alias("size"), F.lit(1).alias("top"), F.lit(0).cast("long").alias("lead"))
    pairs = neardup.across(rows, 0.8)
    assert pairs.count() == n * (n - 1) // 2 and pairs.distinct().count() == n * (n - 1) // 2
    found = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert found.count("Generate") == 2
    tiles = -(-(n - 1) // neardup.SIDE)
    copies = n * tiles + (n - 1) * -(-n * (n - 1) // (neardup.BLOCK * tiles))
    assert copies <= 2.1 * n * n / neardup.SIDE


def test_language_sample_is_bounded_in_code_points(spark):
    rows = [(i, ("the cat sat " if i % 2 else "der hund lief ") * 20, "en" if i % 2 else "de", None, None) for i in range(400)] + [(None, "no id at all", "en", None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert langid.learn(df, langid.Parameters(most_total=0)).languages == []
    whole = langid.learn(df)
    assert whole.languages == ["de", "en"] and langid.learn(df.repartition(5), langid.Parameters(most_total=8_000)).languages == ["de", "en"]
    assert whole.predict(["der hund", "the cat"])[0] == ["de", "en"]


def test_token_counts_are_linear_in_one_unbroken_piece():
    import time

    from tokenizers import Tokenizer

    path = queries.vocabulary_path()
    library, machine = Tokenizer.from_file(path), tokencount.transducer(path)
    rng = np.random.default_rng(3)
    letters = "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 200_000))
    for text in (letters, "=" * 120_000, " " * 70_000 + "x", "x1" * 3000 + letters[:9000] + " ab " + "é" * 5000, "'" * 3000 + "s" * 4000):
        assert machine.texts([text, "a b"]) == [len(library.encode(t, add_special_tokens=False).ids) for t in (text, "a b")]
    machine.texts([letters])
    start = time.monotonic()
    got = machine.texts([letters * 5])[0]
    assert time.monotonic() - start < 4 and abs(got - 5 * machine.texts([letters])[0]) < 25


def test_chat_keeps_roles_and_loses_no_turn(spark):
    unread = "\x01" * (23 << 20)  # 138 MiB as JSON, beyond what a variant holds
    roles = ("bot", "Model", "GPT", "human", "User", "assistant", "ASSISTANT", " user")
    rows = [(1, t, r, f"{r} says") for t, r in enumerate(roles)] + [(2, 0, "user", unread), (2, 1, "system", "short"), (3, 0, "user", "hi"), (3, 1, "assistant", unread), (4, 0, "GPT", unread)]
    got = chat.format_rows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = got.select("conv_id", chat.read_back(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l"))
    got = {r["conv_id"]: r for r in got.select("conv_id", F.transform("t", lambda t: F.struct(t["role"], F.md5(t["text"]))).alias("t"), F.md5("l").alias("l")).collect()}
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    for c in (1, 2, 3, 4):
        assert [tuple(t) for t in got[c]["t"]] == [(r, md5(x)) for i, _, r, x in rows if i == c]
        assert got[c]["l"] == md5("".join(x for i, _, r, x in rows if i == c and r == "assistant"))


def test_chat_query_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    for table in ("conversations",):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.ORACLE_SQL["op1_chat_format"])
    got = queries.op1_chat_format(spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())


# 2 and 10


def test_toxicity_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").filter("toxic is not null").select("doc_id", "predicted", "toxic").collect()
    apart = [r for r in got if folded(r["doc_id"])]
    # a few labels there name documents without any word that other toxic documents share
    assert sum(r["predicted"] != (r["toxic"] > 0) for r in apart) <= 0.1 * len(apart) and sum(r["predicted"] > r["toxic"] for r in apart) <= 0.04 * len(apart)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs, langid.learn(docs)).select("doc_id", "lang", "lang_pred").collect()
    apart = [r for r in got if folded(r["doc_id"])]
    assert sum(r["lang"] != r["lang_pred"] for r in apart) <= 0.03 * len(apart)


def test_misspelled_words_share_subwords():
    sample = [(f"the day was {w} and long{i}", 1) for i, w in enumerate(["horridword", "horridwords", "horridwort"] * 20)] + [(f"the day was nice and long{i} so", 0) for i in range(60)]
    model = toxicity.fit(sample, {1: 60, 0: 60})
    a, b = model.score(["the day was horridwurd and long", "the day was pleasant and long"])
    assert a > 0.5 > b


def test_classifiers_on_odd_rows(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.score(odd, toxicity.learn(odd, none)).collect()
    assert len(got) == len(ODD) and all(r["score"] == 0 for r in got)
    labels = spark.createDataFrame([(4, 1, 1), (4, 1, 0), (6, None, 0), (2, 0, 0), (99, 0, 1), (None, 0, 1), (7, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score(odd, toxicity.learn(odd, labels)).collect()
    assert len({r["score"] for r in got if r["doc_id"] in (4, 5)}) == 1 and all(0 <= r["score"] <= 1 for r in got)
    found = {r["doc_id"]: r for r in langid.identify(odd, langid.learn(odd)).collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and found[6]["lang_pred"] in ("en", "de")
    empty = odd.limit(0)
    assert langid.identify(empty, langid.learn(empty)).count() == 0 and toxicity.score(empty, toxicity.learn(empty, labels)).count() == 0


def test_samples_keep_frequent_labels_and_all_labels(spark):
    frequent = spark.range(3_000_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("label"))
    assert 1 <= samples.pick(frequent, 2, 100)[0].count() <= 3
    many = spark.range(600).select(F.col("id").alias("doc_id"), (F.col("id") % 300).cast("string").alias("label"))
    chosen, counts = samples.pick(many, 10, 10_000)
    assert chosen.count() == 600 and len(counts) == 300
    few, counts = samples.pick(many, 10, 300)
    assert 200 < few.count() <= 376 and len(counts) == 300
    words = many.select("doc_id", F.concat(F.lit("w"), "label").alias("text"), F.col("label").alias("lang"))
    assert len(langid.learn(words, langid.Parameters(per_class=10, epochs=1)).languages) > 256


def test_very_long_texts_score_as_the_sum_of_their_parts(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    models = toxicity.learn(docs, labels), langid.learn(docs)
    texts = [r["text"] for r in docs.filter("n_chars > 3000").limit(20).collect()] + ["", "x" * 5000, "\u0391\u03a3 " * 2000]
    whole = models[0].score(texts), models[1].predict(texts), darts.words(texts)
    for module in (toxicity, langid, darts):
        monkeypatch.setattr(module, "PIECE", 900)
        monkeypatch.setattr(module.pieces_of, "__defaults__", (900,))
    parts = models[0].score(texts), models[1].predict(texts), darts.words(texts)
    plain = [i for i in range(len(texts)) if i != len(texts) - 2]
    assert np.allclose(whole[0][plain], parts[0][plain]) and [whole[1][0][i] for i in plain] == [parts[1][0][i] for i in plain] and np.allclose(whole[1][1][plain], parts[1][1][plain], atol=2e-6)
    for i in plain:
        assert np.array_equal(*(h[at[i] : at[i + 1]] for h, at in (whole[2], parts[2])))


def brute_grams(word, orders, bits):
    """Buckets of a word's n-grams, one code point at a time."""
    from tidemill.llm.codes import mix

    codes, out = [1, *map(ord, word), 1], []
    for n in orders:
        for i in range(len(codes) - n + 1):
            h = codes[i] * 0x9E3779B97F4A7C15 % 2**64
            for c in codes[i + 1 : i + n]:
                h = (h * 0x100000001B3 + c) % 2**64
            out.append(int(mix(np.array([(h + n) % 2**64], np.uint64))[0] >> np.uint64(64 - bits)))
    return out


def test_classifiers_equal_a_slow_scorer(spark):
    """Every score from its definition, word by word and n-gram by n-gram."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    tox, lang = toxicity.learn(docs, labels), langid.learn(docs)
    got = {r["doc_id"]: r for r in toxicity.score(docs, tox, names=("tox", "bad")).collect()}
    told = {r["doc_id"]: r for r in langid.identify(docs, lang).collect()}
    for r in docs.filter("n_chars < 1500").limit(40).collect():
        words = re.findall(r"[^\W_]+", r["text"].lower())
        value = {w: float(np.mean([tox.table[b] for b in brute_grams(w, tox.orders, tox.bits)] or [0.0])) for w in set(words)}
        top = sorted({round(v, 9) for v in value.values()}, reverse=True)[: tox.top]
        z = np.mean(top) + tox.bias if top else -30.0
        assert got[r["doc_id"]]["tox"] == pytest.approx(1 / (1 + np.exp(-z)), abs=2e-6) and got[r["doc_id"]]["bad"] == (got[r["doc_id"]]["tox"] >= 0.3)
        grams = [b for w in words for b in brute_grams(w, lang.orders, lang.bits)]
        z = (np.mean([lang.table[b] for b in grams], axis=0) if grams else 0) + lang.bias
        p = np.exp(z / lang.heat - np.max(z / lang.heat))
        assert told[r["doc_id"]]["score"] == pytest.approx((p / p.sum()).max() if re.search(r"[^\W\d_]", r["text"]) else 0.0, abs=2e-6)


# 3


def test_media_reads_back_what_was_stored(spark, odd, tmp_path):
    root = "file://" + str(tmp_path)
    got = media.with_features(media.with_metadata(media.media_index(odd, root), root), root).collect()
    assert len(got) == len(ODD)
    texts = Counter((r[0], r[1] or "") for r in ODD)
    for r in got:
        match = [t for (i, t) in texts if i == r["doc_id"]]
        payloads = [media.padded(t.encode()) for t in match]
        p = next(p for p in payloads if hashlib.sha256(p).hexdigest() == r["payload_sha256"])
        assert r["payload_bytes"] == len(p) and r["tail_crc32"] == zlib.crc32(p[-16:]) and r["feature"] == media.feature(p)
        assert (r["width"], r["height"]) == (192, len(p) // 192) and hashlib.sha256(media.to_png(p)).hexdigest() == r["media_sha256"]
    import glob
    import tarfile

    for path in glob.glob(f"{tmp_path}/shards/*.tar"):
        with tarfile.open(path) as shard:
            for member in shard:
                assert hashlib.sha256(media.from_png(shard.extractfile(member).read())).hexdigest() == member.name[:-4]
    assert media.media_index(odd.limit(0), root + "/none").count() == 0


# 4


def wanted_mix(rows):
    words = Counter()
    for source, n in rows:
        words[source] += n
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, total = {}, sum(words.values())
    while True:
        rest = total - sum(target.values())
        open_ = [s for s in order if s not in target]
        above = [s for s in open_ if weight[s] * rest / sum(weight[t] for t in open_) > 3 * words[s]]
        if not above:
            return target | {s: weight[s] * rest / sum(weight[t] for t in open_) for s in open_}
        for s in above:
            target[s] = 3 * words[s]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_mix_meets_its_targets(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
    got = queries.op4_source_mix(spark, f"/root/testdata/sf{sf}").join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in got}
    assert all(r["size"] == sizes[r["doc_id"]] and r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in got)
    want, taken, largest = wanted_mix([(r["source"], r["size"]) for r in got]), Counter(), Counter()
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in want)


def test_mix_on_odd_rows(spark, odd):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD) and all(r["copies"] * r["size"] <= 3 * r["size"] for r in got)
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.repeated(odd.limit(0)).count() == 0
    out = mixing.repeated(odd)
    assert out.columns == odd.columns and sorted(r["copies"] for r in got) == sorted(r["copies"] for r in mixing.mix(odd).collect())
    assert out.count() == sum(r["copies"] for r in got)


# 5 and 9


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.vocabulary_path())


def odd_texts(n=1500):
    import random

    rng = random.Random(4)
    letters = "abst 's'll''re 've 'd  \n\n\t the 12 ٣ é ñ …!?-- <|endoftext|> I'm you're   x日本語 aaaaaaaa ======== \U0001f600  \x1c\x85"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["", "a" * 5000, " " * 300, "\n\n  x", "it's 's s's ''s don't'll'", "a<|endoftext|><|endoftext|> b", LONG]


def test_tokens_equal_the_librarys(library, documents):
    texts = odd_texts() + [r["text"] for r in documents.collect()]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    v = vocabulary(queries.vocabulary_path())
    assert bpe.Encoder(v, kept=500).encode(texts) == want
    assert tokencount.Transducer(v).texts(texts) == list(map(len, want))
    assert tokencount.Transducer(v, chunk=8).texts(texts) == list(map(len, want))
    assert [bpe.decode(ids, v) for ids in want] == texts


def test_long_texts_in_segments(library, monkeypatch):
    v = vocabulary(queries.vocabulary_path())
    texts = [LONG[:90_000], "x" * 700 + "<|endoftext|>" * 40 + "12ab 's \n\n  b\n" * 300, "<|endoftext|>", "\n \n" * 900 + "a1b2" * 400]
    monkeypatch.setattr(bpe, "PIECE", 200)
    monkeypatch.setattr(tokencount, "BLOCK", 200)
    monkeypatch.setattr(bpe.segments, "__defaults__", (50,))
    n, digests, back, ids = bpe.Encoder(v).read(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [i for x in ids for i in x.to_pylist()] == [i for x in want for i in x] and n == list(map(len, want)) == tokencount.Transducer(v).texts(texts)
    assert digests == [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in want] and back == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    assert ["".join(bpe.segments(t, 50)) for t in texts] == texts and len(list(bpe.segments(texts[0], 50))) > 1000


def test_pieces_do_not_depend_on_chunks():
    texts = odd_texts(300)
    want = pretokens.Chunks(texts, 1 << 13).starts()
    assert all(np.array_equal(want, pretokens.Chunks(texts, c).starts()) for c in (1, 2, 7, 256))
    assert pretokens.pieces(texts) == [bpe.CUT.findall(t) for t in texts] and pretokens.SETTLED < 8


def test_composed_maps_hold_for_every_entry():
    """A chunk's count by the state it is entered in: that of the rest of a text from there, read one symbol at a time."""
    v = vocabulary(queries.vocabulary_path())
    machine = tokencount.Transducer(v, chunk=8)
    assert machine.texts([]) == [] and machine.texts([""]) == [0]
    rng = np.random.default_rng(5)
    maps = rng.integers(0, 8, (37, 8)).astype(np.uint8)
    counts = rng.integers(-3, 9, (37, 8))
    state, total = np.arange(8), np.zeros(8, int)
    got = pretokens.compose(maps, counts)
    for i in range(37):
        total, state = total + counts[i][state], maps[i][state]
        assert np.array_equal(got[0][i], state) and np.array_equal(got[1][i], total)
    # what each chunk emits by its entry, against reading on from there symbol by symbol
    texts = [t for t in odd_texts(40) if "<|endoftext|>" not in t][:30] + ["it's 'll 're we'd've '' 'x", "  a  b\n\n c"]
    chunks, counted = machine.annotated(texts)
    codes, stops = pack(texts)
    symbol, every = pretokens.symbols(codes, stops), "\n".join(texts) + "\n"
    back = {int(g): i for i, g in enumerate(chunks.place)}
    for row in range(len(chunks.maps)):
        if row * 8 not in back:
            continue
        first = back[row * 8]
        text = int(np.searchsorted(stops, first))
        for entry in range(8):
            at, cuts, state = first, [], entry
            while at <= stops[text]:
                if pretokens.MARK[symbol[at] * 8 + state]:
                    cuts.append(at)
                state = int(pretokens.GO[symbol[at] * 8 + state])
                at += 1
            own = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < first + 8]
            assert counted[row][entry] == sum(machine.run(every[a:b].encode()) for a, b in own), (row, entry)


def test_token_queries(spark, odd, library):
    texts = {(r[0], r[1]) for r in ODD}
    path = queries.vocabulary_path()
    counts, codes = tokencount.count(odd, path).collect(), bpe.encode(odd, path).collect()
    assert len(counts) == len(codes) == len(ODD) and tokencount.count(odd.limit(0), path).count() == 0
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert any(r["doc_id"] == doc_id and r["n_tokens"] == len(ids) and r["over_limit"] == (len(ids) > 512) and r["n_bytes"] == len((text or "").encode()) for r in counts)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert any(r["doc_id"] == doc_id and r["ids"] == ids and r["ids_sha256"] == digest and r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest() for r in codes)


# 6


def brute_spots(rows):
    """rows in order: what compare() gives, with signatures found word by word."""

    def marks(text):
        words = spots.WORD.findall(text.lower())
        out = set()
        for i, w in enumerate(words):
            if w in spots.ANCHORS:
                after = [x for x in words[i + 1 :] if x not in spots.ANCHORS][: spots.CHAIN]
                if len(after) == spots.CHAIN:
                    out.add(zlib.crc32(" ".join([w, *after]).encode()))
        return out or ({zlib.crc32(" ".join(words).encode())} if words else set())

    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        mixed = t[: len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(mixed.encode()).hexdigest(), like(marks(t), marks(mixed)), like(marks(t), marks(after))))
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_spots_equal_brute_force(spark, documents, odd, parts):
    small = documents.filter("n_chars < 3000")
    for df in (small, odd.filter("doc_id is null or doc_id != 6")):
        rows = sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
        got = spots.compare(df, parts).collect()
        key = lambda x: str(x)
        assert sorted([(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got], key=key) == sorted(brute_spots(rows), key=key)
    assert spots.compare(odd.limit(0), parts).count() == 0
    one = spots.compare(odd.filter("doc_id = 7"), parts).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


@pytest.mark.parametrize("least", [0.7, 0.8])
def test_spot_join_equals_brute_force(spark, documents, odd, monkeypatch, least):
    monkeypatch.setattr(neardup, "BLOCK", 40)
    rng = np.random.default_rng(8)
    base = " ".join(f"the {a} {b}" for a, b in zip(rng.integers(0, 900, 60), rng.integers(0, 900, 60))).split()
    near = [(5000 + i, " ".join(w if rng.random() > 0.004 * (i % 9) else f"z{i}" for w in base[: 180 - 3 * (i % 5)])) for i in range(80)]
    df = documents.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string")).unionByName(odd.filter("doc_id != 6").select((F.col("doc_id") + 9000).alias("doc_id"), "text"))
    rows = [(r["doc_id"], spots.signatures(r["text"] or "")) for r in df.collect()]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j in range(i):
            b = rows[j][1]
            if a == b or (a and b and len(a & b) >= least * len(a | b) - 1e-9):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    want: dict = {}
    for i, (doc, _) in enumerate(rows):
        want.setdefault(root(i), []).append(doc)
    got: dict = {}
    for r in spots.similar(df, least).collect():
        got.setdefault(r["class_id"], []).append(r["doc_id"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and all(k == min(v) for k, v in got.items())
    assert spots.similar(odd.limit(0)).count() == 0


# 7


def brute_classes(rows, least=0.8):
    def marks(text):
        words = re.findall(r"[^\W_]+", text.lower())
        if not words:
            return {text}
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}

    sets = [marks(t or "") for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j > i}:
            both = len(s & sets[j])
            if both >= least * (len(s) + len(sets[j]) - both) - 1e-9:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = {}
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        for i in g:
            out[i] = min(ids) if ids else None
    return [(rows[i][0], out[i]) for i in range(len(rows))]


def test_near_duplicates_equal_brute_force(spark, documents, odd):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    near = []
    for i in range(150):
        words = list(base)
        for at in rng.integers(0, 300, int(rng.integers(0, 14))):
            words[at] = f"x{rng.integers(0, 10**6)}"
        near.append((10_000 + i, " ".join(words)))
    more = spark.createDataFrame(near, "doc_id long, text string")
    df = documents.select("doc_id", "text").unionByName(more).unionByName(odd.select((F.col("doc_id") + 20_000).alias("doc_id"), "text"))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = [(r["doc_id"], r["class_id"]) for r in neardup.classes(df).collect()]
    assert Counter(got) == Counter(brute_classes(rows))
    kept = neardup.one_of_each(df)
    assert kept.columns == df.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter({i for _, i in got})


@pytest.mark.parametrize("block", [1, 50, neardup.BLOCK])
def test_large_buckets_go_on_until_all_is_compared(spark, documents, monkeypatch, block):
    monkeypatch.setattr(neardup, "SMALL", 2)
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "ROWS", 1)
    monkeypatch.setattr(neardup, "BANDS", 6)
    df = documents.filter("doc_id < 60").select("doc_id", "text")
    rng = np.random.default_rng(2)
    words = " ".join(f"w{i}" for i in range(60)).split()
    near = [(1000 + i, " ".join(words[: 40 + i] + [f"y{i}{j}" for j in range(20 - i)])) for i in range(15)]
    df = df.unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert {(r["doc_id"], r["class_id"]) for r in neardup.classes(df).collect()} == set(brute_classes(rows)) and rng


@pytest.mark.parametrize("least", [0.3, 0.5])
def test_lower_thresholds_have_their_classes(spark, least):
    rows = []
    for i in range(120):
        # of n shingles, two texts with n - k in common are (n - k) / (n + k) similar, here just above the threshold
        words, shared = [f"a{i}x{j}" for j in range(104)], 4 + int(np.ceil(200 * least / (1 + least))) + 1
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:shared] + [f"b{i}x{j}" for j in range(104 - shared)]))]
    # and a cluster of texts of different lengths
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(30 + i))) for i in range(0, 70, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["class_id"]) for r in neardup.classes(df, least).collect()]
    assert Counter(got) == Counter(brute_classes(rows, least))


def test_banding_serves_the_threshold():
    assert neardup.banding(0.8) == neardup.banding(0.95) == (24, 5)
    for least in (0.05, 0.3, 0.5, 0.7, 0.79):
        bands, rows = neardup.banding(least)
        assert (1 - least**rows) ** bands <= neardup.MISS
    for wrong in (0, -1, 1.01):
        with pytest.raises(ValueError):
            neardup.banding(wrong)


def test_near_duplicates_of_an_empty_table(odd):
    assert neardup.classes(odd.limit(0)).count() == 0 and neardup.one_of_each(odd.limit(0)).count() == 0


def test_darts_agree_as_weighted_jaccard():
    elements, owner = np.array([1, 2, 3, 1, 2, 4], np.uint64) * np.uint64(7919 * 7919), np.array([0, 0, 0, 1, 1, 1])
    weights = np.array([1.5, 2.2, 0.3, 2.5, 1.1, 0.7])
    s = darts.signatures(owner, elements, weights, 2, 20000)
    assert (s[0] == s[1]).mean() == pytest.approx((1.5 + 1.1) / (2.5 + 2.2 + 0.3 + 0.7), abs=0.02)


def test_weighted_links(spark):
    rows = [(1, "a b c d e " * 4), (2, "a b c d e " * 9), (3, "a b c d e " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len({r["class_id"] for r in neardup.classes(df).collect()}) == 1
    assert len({r["class_id"] for r in neardup.classes(df, weighted=True).collect()}) > 1


# 8


def test_extraction_of_the_tables_pages(spark):
    import html

    got = {r["page_id"]: r for r in queries.op8_main_text(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_extraction_of_odd_pages(spark):
    menu = "<ul>" + "".join(f"<li><a href=/{i}>item {i}</a></li>" for i in range(9)) + "</ul>"
    full = f"""<html><body><header><h1>Site</h1>{menu}</header><div id="cookie-notice">We use cookies ok</div><main><article><h1>T</h1><p>Hello &amp; world
        this is prose.</p><aside class="related">More like this now</aside><script>var x = "<p>no</p>";</script><p>Second <a href=x>link</a> para<br>line.</p><form><label>Email</label></form>
        </article><section class="comments"><p>Great post by reader one two three</p></section></main><footer>c 2020</footer></body></html>"""
    rows = [(1, None, None), (2, "u", ""), (3, "u", full), (3, "u", full), (4, "u", "<p>just words"), (None, "u", "<p>a &lt;b&gt; c <!-- no --> d"), (5, "u", "<p>cut <b"), (6, "u", f"<nav>{menu}</nav>")]
    got = [(r["page_id"], r["text"]) for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = "T\n\nHello & world this is prose.\n\nSecond link para line."
    assert Counter(got) == Counter([(1, ""), (2, ""), (3, want), (3, want), (4, "just words"), (None, "a <b> c d"), (5, "cut"), (6, "")])


ARTICLE = "<article><h1>Title</h1><p>Some prose of the first kind here.</p>{}<p>More prose of another kind.</p></article><footer>c 2020</footer>"
PROSE = "Title\n\nSome prose of the first kind here.{}\n\nMore prose of another kind."
OPEN = ['<svg viewBox="0 0 9 9"/>', "<math/>", '<svg class="menu"><path d="M0 0">', "<svg><title>Icon</svg>", "<svg><style/><path/></svg>", '<button class="share menu">', "<button>Share", "<select><option>One<option>Two", '<object data="x">', "<template>"]


@pytest.mark.parametrize("tag", OPEN)
def test_unclosed_elements_take_no_article(tag):
    name = re.match(r"<(\w+)", tag)[1]
    for later in ("", f"<div><{name}>no</{name}></div>"):
        assert pages.main_text(tag + ARTICLE.format("") + later) == PROSE.format("")
        assert pages.main_text(f"<body><div>{tag}</div>" + ARTICLE.format("") + later) == PROSE.format("")
        assert pages.main_text(ARTICLE.format(tag) + later) == PROSE.format("")
        assert pages.main_text(ARTICLE.format(f"<p>Then this.{tag}</p>") + later) == PROSE.format("\n\nThen this.")


def test_closed_elements_in_paragraphs():
    countries = "".join(f"<option>Land {i}</option>" for i in range(200))
    for inside in ("<svg><g><text>no</text></g></svg>", "<button><div>no</div></button>", f"<select>{countries}</select>", "<object><p>no</p></object>", "<template><p>no</p></template>", "<svg><style>a{}</style></svg>"):
        assert pages.main_text(ARTICLE.format(f"<p>Left {inside} right.</p>")) == PROSE.format("\n\nLeft right."), inside
    formula = "<math><mrow><mi>x</mi><mo>+</mo><mn>1</mn></mrow></math>"
    assert pages.main_text(ARTICLE.format(f"<p>Let {formula} be odd.</p>")) == PROSE.format("\n\nLet x+1 be odd.")
    assert pages.main_text(ARTICLE.format("<p>Then this.</p><script>var a = '<svg>';")) == "Title\n\nSome prose of the first kind here.\n\nThen this."


@pytest.mark.parametrize(
    "source,want",
    [
        (ARTICLE.format("<div class='ad'>" + "buy this now " * 25 + "</div>"), PROSE.format("")),
        (ARTICLE.format("<div class='read-more'><p>A paragraph of the article.</p></div>"), PROSE.format("\n\nA paragraph of the article.")),
        ("<p title=it's>One two three.</p><p>Four five six.</p><p>Seven isn't it.</p>", "One two three.\n\nFour five six.\n\nSeven isn't it."),
        ("<p title='a > b' class=x>One two three.</p>", "One two three."),
        ("<head><title>Name<body><article><p>One two three four.</p></article>", "One two three four."),
        ("<article><p>One two three.</p><textarea>draft<p>Four five six.</p></article>", "One two three.\n\nFour five six."),
        ("<div class='content'><p>One two three four five.</p><div class='advert'>" + "buy " * 80 + "</div><p>Six seven.</p></div><div class='comments'><p>Great post.</p></div>", "One two three four five.\n\nSix seven."),
        ("<p>a = b < c</p>", "a = b < c"),
    ],
)
def test_pages_lose_no_text(source, want):
    assert pages.main_text(source) == want


LEAD = "The lead of it."
WITHIN = "<nav><ul><li><a>x y</a></li></ul></nav>" + ARTICLE


@pytest.mark.parametrize(
    "part",
    [
        "<header><p>{}</p></header>", "<section class='social-science'><p>{}</p></section>", "<section class='menu-planning'><p>{}</p></section>", "<div class='story-header'><p>{}</p></div>",
        "<div class='storyHeader'>{}</div>", "<p class='tags'>{}</p>", "<div class='zyx'><p>{}</p></div>",
    ],
)
def test_an_articles_own_parts_stay(part):
    assert pages.main_text(WITHIN.format(part.format(LEAD))) == PROSE.format("\n\n" + LEAD)


@pytest.mark.parametrize(
    "part",
    [
        "<div class='ad'><p>{}</p></div>", "<aside><p>{}</p></aside>", "<nav><p>{}</p></nav>", "<form><p>{}</p></form>", "<footer><p>{}</p></footer>", "<div class='article-comments'><p>{}</p></div>",
        "<div class='related-list'><p>{}</p></div>", "<div class='zyx-advert'>{}</div>", "<div class='newsletter'><p>{}</p></div>", "<div class='cookie-notice'><p>{}</p></div>", "<div class='share-links'><p>{}</p></div>",
    ],
)
def test_what_stands_in_an_article_without_being_part_of_it_goes(part):
    assert pages.main_text(WITHIN.format(part.format(LEAD))) == PROSE.format("")


@pytest.mark.parametrize("body", ["<body>", "<body class='has-sidebar'>"])
def test_a_menu_does_not_end_a_page_without_an_article(body):
    menu = "<ul class=menu>" + "<li><a>item one</a></li>" * 9 + "</ul>"
    source = f"{body}<h1>Title here</h1><p>One two three four.</p>{menu}<p>Five six seven eight.</p><footer><p>c 2020</p></footer></body>"
    assert pages.main_text(source) == "Title here\n\nOne two three four.\n\nFive six seven eight."


def test_deep_nesting_takes_time_in_proportion():
    import time

    for opened in ("<div class='c{}x'>", "<b id='c{}x'>", "<p><object><div class='c{}'>"):
        source = "".join(opened.format("".join(chr(97 + i // 26**k % 26) for k in range(3))) for i in range(20_000))
        pages.main_text("<p>Words that warm up.</p>")
        began = time.process_time()
        got = pages.main_text(source + "<article><p>One two three.</p></article>")
        assert time.process_time() - began < 3 and (got == "One two three." or "object" in opened)


def test_names_hold_where_their_elements_do():
    """Names of each text run against a plain walk up the tree, and scores against the sum over all names."""
    source = "<div class='a b-c'><p class=a>One<b id=d>two</b></p><article class=a><h1>Three</h1><section class=a><i>four</i></section></article></div><p>Five</p>"
    page = pages.read(source)
    names = [page.names(x.node) for x in page.items if isinstance(x, pages.Text)]
    outer = {"<div>", "a", "=b-c", "b-", "-c"}
    within = outer | {"<article>"}
    assert names == [outer | {"<p>"}, outer | {"<p>", "<b>", "d"}, within | {"<h1>", "in <h1>"}, within | {"<section>", "in <section>", "in a", "<i>", "in <i>"}, {"<p>"}]
    w = pages.weights()
    scores = page.scores(w)
    for x in page.items:
        if isinstance(x, pages.Text):
            assert scores[x.node] == pytest.approx(w.bounded(w.bias + sum(w.names.get(n, 0.0) for n in page.names(x.node))))


def test_weights_learned_from_the_tables_pages(spark):
    """Held-out pages are exact with weights of the others, and an empty table leaves those of the pages made here."""
    import html

    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    w = pages.learn(table)
    assert w.names["<article>"] > 1 and w.names["ad"] < -1
    got = {r["page_id"]: r["text"] for r in pages.extract(table, w).collect()}
    for r in table.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)
    assert pages.learn(table.limit(0)).names == pages.weights().names and pages.extract(table.limit(0)).count() == 0


# the queries as they are registered

COLUMNS = {
    "op1_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op2_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_media_columns": "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string",
    "op4_source_mix": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op5_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op6_spot_signatures": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op7_near_duplicates": "doc_id bigint, class_id bigint",
    "op8_main_text": "page_id bigint, url string, text string, n_chars bigint",
    "op9_bpe_codec": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op10_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op11_prefix_trie": "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string",
    "op12_hard_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
    "op13_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
}


def test_registered_queries_against_brute_force(spark, documents, library):
    got = {}
    assert set(COLUMNS) == set(queries.QUERIES)
    for name, told in COLUMNS.items():
        df = queries.QUERIES[name](spark, SF)
        types = dict(df.dtypes)
        assert {c.split()[0]: c.split()[1] for c in told.split(", ")}.items() <= types.items(), name
        got[name] = [r.asDict() for r in df.collect()]
    docs = sorted(((r["doc_id"], r["text"] or "") for r in documents.collect()), key=lambda r: -r[0])
    sha = lambda b: hashlib.sha256(b).hexdigest()
    by = {n: {r["doc_id"]: r for r in rows} for n, rows in got.items() if n not in ("op1_chat_format", "op8_main_text", "op11_prefix_trie", "op12_hard_negatives")}
    assert all(len(got[n]) == len(docs) == len(by[n]) for n in by)
    spotted = {i: (n, digest, a, b) for i, n, digest, a, b in brute_spots(docs)}
    classes = dict(brute_classes(docs))
    for i, text in docs:
        data, payload = text.encode(), media.padded(text.encode())
        r = by["op3_media_columns"][i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["feature"]) == (len(data), len(payload), sha(payload), zlib.crc32(payload[-16:]), media.feature(payload))
        assert (r["media_bytes"], r["media_sha256"]) == (len(media.to_png(payload)), sha(media.to_png(payload)))
        ids = library.encode(text, add_special_tokens=False).ids
        r = by["op5_token_counts"][i]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(data), len(ids), len(ids) > 512)
        r = by["op9_bpe_codec"][i]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids)).encode()), sha(data))
        r = by["op6_spot_signatures"][i]
        assert (r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) == spotted[i]
        assert by["op7_near_duplicates"][i]["class_id"] == classes[i]
        r = by["op4_source_mix"][i]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text)) and r["taken"] <= 3 * r["size"]
        for n in ("op2_toxicity", "op10_language_id"):
            assert by[n][i]["held_out"] == folded(i) and 0 <= by[n][i]["score"] <= 1
        assert by["op2_toxicity"][i]["predicted"] == int(by["op2_toxicity"][i]["score"] >= 0.3)


# the pipeline


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_runs_on_odd_rows(spark, tmp_path, empty):
    """Odd, repeated and empty rows, and columns that the stages use themselves, in any case of letters."""
    import corpus_pipeline as c

    text = "the quick brown fox and the lazy dog are in the garden with all of the others"
    rows = [*[(r[0], r[1], r[2], r[3], r[4]) for r in ODD], *[(100 + i, f"{text} number{i} {'x' * (i % 7)} and so on it goes with {i * 7919}", "en", "a", 90) for i in range(40)]]
    rows += [(200 + i, f"der schnelle braune fuchs und der faule hund sind im garten mit {i * 7907} anderen tieren", "de", "b", 80) for i in range(40)]
    more = [(*r, 0.5, 1, "xx", "k", 3, True, "p") for r in rows]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, Score double, Predicted int, lang_pred string, _key string, size int, accepted boolean, _score string"
    docs = spark.createDataFrame(more, kinds).limit(0 if empty else len(more))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, int(i % 4 == 0)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert c.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    seen = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in c.STAGES[:-1]:
        before = Counter(map(str, seen.collect()))
        seen = neardup.stored(stage(spark, seen, str(tmp_path)), name)
        assert seen.schema.names == docs.schema.names, name
        after = Counter(map(str, seen.collect()))
        assert set(after) <= set(before) and all(n <= before[r] for r, n in after.items() if name != "mix"), name
    assert bool(seen.count()) != empty


def test_pipeline_stages(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    for name, stage in c.STAGES[:-1]:
        before = docs.collect()
        docs = neardup.stored(stage(spark, docs, "/root/testdata/sf0.01"), name)
        assert docs.columns == list(before[0].asDict())
        after = docs.collect()
        gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
        if name == "toxicity":
            toxic = sum(x == 1 for x in labels.values())
            assert sum(not labels.get(i, 1) for i in gone) <= 0.02 * len(before) and sum(labels.get(r["doc_id"]) == 1 for r in after) <= 0.3 * toxic
        if name == "language":
            assert len(gone) <= 0.02 * len(before)
        if name == "near_duplicates":
            assert {r["doc_id"] for r in after} == {i for _, i in brute_classes([(r["doc_id"], r["text"]) for r in before])}
        if name == "mix":
            copies = Counter(r["doc_id"] for r in after)
            assert max(copies.values()) <= 3
    assert c.STAGES[-1][1](spark, docs, "").count() == docs.count()
