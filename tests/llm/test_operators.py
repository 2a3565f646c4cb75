"""Each operator against a plain version of it, over the smallest tables or made-up texts."""

import base64
import hashlib
import random
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF_DIR

from strataprop.llm import decontaminate, packing, words
from strataprop.llm.components import components
from strataprop.llm.ftrl import Ftrl, probabilities, temperature
from strataprop.llm.ngram_join import near_duplicates
from strataprop.llm.pii import find_pii, redact
from strataprop.llm.quality import repetition_quality
from strataprop.llm.queries import QUERIES, TOKENIZER, URL_RULES
from strataprop.llm.sharding import number_within, rendezvous, shard_records
from strataprop.llm.url_filter import filter_urls


@pytest.fixture(scope="module")
def docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def pages(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()]


# --- word kernel ------------------------------------------------------------------------------


def test_words_do_not_cross_texts_or_depend_on_block_size():
    texts = ["ab", "cd ef", "", None, "ß\u00a0x\x1cy", " a\tb\r\n", "é"]
    for limit in (1, 4, 1 << 20):
        found = []
        for block in words.blocks(pa.array(texts), limit):
            starts, ends, bounds = block.ranges(words.WHITE)
            raw = block.data.tobytes()
            for k in range(block.texts()):
                found.append([raw[a:b].decode() for a, b in zip(starts[bounds[k]:bounds[k + 1]], ends[bounds[k]:])])
        assert found == [brute.WORD.findall(t or "") for t in texts]


def test_equal_ranges_and_only_those_have_equal_hashes():
    text = "to be or not to be To bE"
    block = next(words.blocks(pa.array([text])))
    starts, ends, _ = block.ranges(words.WHITE)
    plain = words.hash_ranges(block.sums(), starts, ends)
    folded = words.hash_ranges(block.sums(fold=True), starts, ends)
    assert len(set(plain.tolist())) == 6 and len(set(folded.tolist())) == 4


# --- op1 ----------------------------------------------------------------------------------------


def test_urls_equal_brute_force(spark, pages):
    for row in QUERIES["op1_url_filters"](spark, SF_DIR).collect():
        url = {p[0]: p[1] for p in pages}[row["page_id"]]
        assert (row["host"], row["path"]) == brute.url_parts(url)
        assert (row["rule"], row["verdict"]) == brute.url_rule(url, URL_RULES)


def test_nested_rules_and_odd_urls(spark):
    rules = [("com", "", "block"), ("a.com", "", "allow"), ("a.com", "/x", "block"), ("a.com", "/x/y", "allow"),
             ("b.a.com", "/x/", "allow"), ("-z.com", "", "allow"), ("net", "/", "block")]
    odd = ["http://a.com", "http://a.com/x", "http://a.com/x/y/z?q", "HTTP://B.A.COM/x/1#f", "http://c.b.a.com/x/y", "x",
           None, "", "://", "http://aa.com/x", "http://q.-z.com/", "http://com./", "http://com", "http://n.net", "http://n.net/",
           "http://a.com:80/x", "http://é.com/x", "a://b://c.com/"]
    rng = random.Random(5)
    labels, steps = ["a", "b", "c", "-z"], ["/", "/x", "/x/y", "/xy", "", "?x", "/y/x"]
    odd += [f"http://{'.'.join(rng.choices(labels, k=rng.randint(0, 3)))}.{rng.choice(['com', 'net', 'org'])}{rng.choice(steps)}"
            for _ in range(300)]
    rules += [("b.com", "/long/path/", "block"), ("a.b.com", "/", "allow")]  # the longer rule, not the longer host
    odd += ["http://a.b.com/long/path/x", "http://a.b.com/long", "http://c.a.b.com/long/path/"]
    pages = spark.createDataFrame(list(enumerate(odd)), "page_id long, url string").repartition(5)
    rules_df = spark.createDataFrame(rules, "host string, path string, verdict string")
    for row in filter_urls(pages, rules_df).collect():
        expected = brute.url_rule(odd[row["page_id"]], rules)
        assert (row["rule"], row["verdict"]) == expected, odd[row["page_id"]]


def test_block_wins_over_allow_for_one_rule_and_bad_rules_fit_nothing(spark):
    rules = spark.createDataFrame(
        [("a.com", "/", "allow"), ("a.com", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("b.com", None, "maybe")],
        "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.com/")], "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in filter_urls(pages, rules).collect()}
    assert found == {1: "block", 2: "allow"}


# --- op2 ----------------------------------------------------------------------------------------


def test_quality_equals_brute_force(spark, docs):
    found = {r["doc_id"]: r for r in QUERIES["op2_quality_rules"](spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for key, text in docs:
        expected = brute.quality(text)
        assert {c: found[key][c] for c in expected} == expected
        failed = expected["n_words"] < 50 or 2 * expected["n_repeat_words"] > expected["n_words"]
        assert found[key]["base_failed"] == failed and not (failed and found[key]["kept"])


def test_repeated_lines_and_passages_are_not_kept(spark):
    rng = random.Random(1)
    fresh = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    texts = {1: " ".join(fresh), 2: "\n".join([" ".join(fresh[:40])] * 3 + [" ".join(fresh[40:])]),
             3: " ".join(fresh[:200] + fresh[50:150])}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in repetition_quality(rows).collect()} == {1: True, 2: False, 3: False}


# --- op3, op8 -----------------------------------------------------------------------------------


def test_language_is_right_on_held_out_rows(spark):
    found = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01")
    true = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(true, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_ranks_held_out_rows(spark):
    found = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    right = np.mean([(r["score"] >= 0.5) == (r["toxic"] == 1) for r in held])
    assert right >= 0.95 and all(r["predicted"] == (r["score"] >= 0.5) for r in found)


def test_ftrl_learns_sparse_weights_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    examples, targets = [], []
    for _ in range(600):
        target = int(rng.integers(3))
        examples.append((np.unique(np.append(rng.integers(3, 2000, 5), target)), None))
        targets.append(target)
    examples = [(x, np.ones(len(x))) for x, _ in examples]
    weights, bias = Ftrl(2000, 3, 0.5, 1.0, 2.0, 0.1).fit(examples, targets, 3).weights()
    assert (weights[:3].argmax(axis=1) == np.arange(3)).all() and (weights[3:] == 0).mean() > 0.95
    scores = np.array([v @ weights[x] + bias for x, v in examples])
    targets = np.array(targets)
    t = temperature(scores, targets)

    def loss(t):
        return -np.log(probabilities(scores / t)[np.arange(len(targets)), targets]).mean()

    assert loss(t) <= min(loss(t * 1.1), loss(t / 1.1), loss(1.0)) + 1e-9


# --- op4 ----------------------------------------------------------------------------------------


def test_base_spans_equal_brute_force(spark, docs):
    rng, letters = random.Random(3), "aA1234567890@@..--__%+ () \n\té"
    made = [(10_000_000 + k, "".join(rng.choices(letters, k=rng.randint(0, 120)))) for k in range(1500)]
    made += [(20_000_000 + k, t) for k, t in enumerate(
        ["a@b.com_x@y.org", "x" * 30_000, "1" * 20_000, "1-" * 5000 + "1", "4111 1111 1111 1111 +1 (555) 123-4567",
         "001.002.003.255 256.1.1.1 1.2.3.4.5.6.7.8.9", "+1((((((((9", None, "", "\U0001f600 a@b.co 1.2.3.4"])]
    rows = docs + made
    found = {r["doc_id"]: r["spans"] for r in find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for key, text in rows:
        assert [(s["kind"], s["start"], s["end"]) for s in found[key] if s["base"]] == brute.pii(text), text


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows = [(k, f"Hello phone number: +1 (555) 010-{1000 + k} thanks {k}") for k in range(20)]
    rows += [(100, "Hello my phone number: (ext.12-77x), ok"), (101, "Hello my street number: ext.12-77x, ok")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in find_pii(frame).collect()}
    assert [(s["kind"], s["start"], s["end"], s["base"]) for s in found[100]] == [("phone", 24, 34, False)]
    assert found[101] == [] and all(len(found[k]) == 1 for k in range(20))
    marked = {r["doc_id"]: r["text"] for r in redact(frame).collect()}
    assert marked[100] == "Hello my phone number: ([phone]), ok"
    assert marked[3] == "Hello phone number: [phone] thanks 3"


# --- op5 ----------------------------------------------------------------------------------------


def test_near_duplicates_equal_brute_force(spark, docs):
    found = sorted(tuple(r) for r in QUERIES["op5_ngram_jaccard_join"](spark, SF_DIR).collect())
    assert found == sorted(brute.near_duplicates(docs))


def test_group_of_near_copies_and_hot_elements(spark, monkeypatch):
    from strataprop.llm import ngram_join
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 3)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(80):
        copy = list(base)
        for at in rng.sample(range(60), rng.randint(0, 4)):
            copy[at] = f"x{rng.randrange(40)}"
        rows.append((k + 1, " ".join(copy[: rng.randint(45, 60)])))
    rows += [(200 + k, f"{' '.join(base[:12])} " + " ".join(f"y{k}_{j}" for j in range(30))) for k in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sorted(tuple(r) for r in near_duplicates(frame).collect()) == sorted(brute.near_duplicates(rows))


def test_components_of_long_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (3, 2)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}


# --- op6 ----------------------------------------------------------------------------------------


def test_alignment_equals_dynamic_programming():
    rng = np.random.default_rng(4)
    for _ in range(100):
        item, text = rng.integers(0, 6, rng.integers(1, 12)), rng.integers(0, 6, rng.integers(0, 30))
        score, first, end = decontaminate.align(item, text)
        assert score == brute.alignment(item.tolist(), text.tolist())
        assert score == brute.alignment(item.tolist(), text[first:end].tolist())


def test_exact_and_edited_copies_are_found_and_others_not(spark):
    rng = random.Random(2)
    common = [f"c{k}" for k in range(5)]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(10**6)}" for _ in range(n)]

    items = {k: prose(30) for k in range(5)}
    rows = [(k, " ".join(prose(200))) for k in range(60)]
    edited = [w if j % 6 else f"e{j}" for j, w in enumerate(items[1])]
    rows += [(100 + k, " ".join(prose(300) + items[0] + prose(50))) for k in range(30)]
    rows += [(200, " ".join(prose(3) + edited)), (201, ", ".join(items[2]).upper()), (202, " ".join(items[3][:5]))]
    found = decontaminate.find_contamination(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")).collect()
    pairs = {(r["doc_id"], r["item_id"]): r for r in found}
    assert set(pairs) == {(100 + k, 0) for k in range(30)} | {(200, 1), (201, 2)}
    assert (pairs[100, 0]["first_word"], pairs[100, 0]["end_word"]) == (300, 330) and pairs[201, 2]["score"] == 1.0


# --- op7 ----------------------------------------------------------------------------------------


def test_pieces_equal_the_tokenizer_and_fill_sequences_without_gaps(spark, docs):
    from tokenizers import Tokenizer
    encoded = Tokenizer.from_file(TOKENIZER).encode_batch([t for _, t in docs], add_special_tokens=False)
    expected = {}
    for (key, _), e in zip(docs, encoded):
        ids = np.array([*e.ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            expected[key, piece] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = QUERIES["op7_packing"](spark, SF_DIR).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values()) <= 4096
    assert len(filled) <= 1.02 * sum(filled.values()) / 4096 + 1


def test_plan_is_near_its_bound_and_complete():
    rng = np.random.default_rng(1)
    for sizes in (np.minimum(rng.lognormal(6.3, 1.2, 50_000).astype(int) + 1, 4096), rng.choice([2100, 1990, 1500], 3000),
                  np.full(7, 4096), np.array([1]), np.array([], int)):
        histogram = np.bincount(sizes, minlength=4097)
        plan = packing.plan(histogram, 4096)
        ends = {n: 0 for n in range(4097)}
        for n, rank in zip(plan.length.tolist(), plan.rank.tolist()):
            assert rank >= ends[n] or rank == 0
            ends[n] = rank
        assert plan.sequences >= plan.lower_bound
        if len(sizes) > 10_000:
            assert plan.sequences <= 1.01 * plan.lower_bound + 1


def test_solver_meets_its_dual_bound():
    sizes, demand = np.array([52, 50, 38]), np.array([1000, 1000, 1000])
    configs, used, bound = packing.solve(sizes, demand, 102)
    made = sum(c * u for c, u in zip(configs, used))
    assert (made >= demand * (1 - 1e-9)).all() and used.sum() <= 1.05 * bound


# --- op9 ----------------------------------------------------------------------------------------


def test_shards_follow_the_key_and_grow_only_into_the_new_one(spark, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op9_sharding"](spark, SF_DIR).collect()}
    slots = {}
    for key, text in docs:
        row, raw = rows[key], text.encode()
        assert (row["size"], row["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert row["grown_shard"] in (row["shard"], 24)
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))


def test_weights_share_out_the_keys_and_a_removed_shard_moves_only_its_own(spark):
    from pyspark.sql import functions as F
    keys = spark.range(40_000)
    counts = dict(keys.select(rendezvous(F.col("id"), [1, 2, 1]).alias("s")).groupBy("s").count().collect())
    assert abs(counts[1] / 40_000 - 0.5) < 0.02 and abs(counts[0] / 40_000 - 0.25) < 0.02
    moved = keys.select(rendezvous(F.col("id"), [1] * 6).alias("a"), rendezvous(F.col("id"), [1] * 5).alias("b"))
    assert moved.filter("a <> 5 and a <> b").count() == 0


def test_numbers_are_gapless_over_many_partitions_and_null_groups(spark):
    frame = spark.range(1000).selectExpr("if(id % 3 = 0, null, id % 2) as g", "id").repartition(9)
    seen = {}
    for r in number_within(frame, "g", "n").collect():
        seen.setdefault(r["g"], []).append(r["n"])
    assert {g: sorted(n) == list(range(len(n))) for g, n in seen.items()} == {None: True, 0: True, 1: True}
    assert shard_records(spark.createDataFrame([(1, "a")] * 5, "doc_id long, text string")).agg(
        {"slot": "max"}).first()[0] == 4


# --- op10 ---------------------------------------------------------------------------------------


def test_archive_round_trip(spark, pages):
    first = {}
    for key, _, html in pages:
        first[html] = min(first.get(html, key), key)
    for r in QUERIES["op10_warc"](spark, SF_DIR).collect():
        html = {p[0]: p[2] for p in pages}[r["page_id"]]
        raw, target = html.encode(), first[html]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
        own = target == r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if own else ("revisit", target))


def test_look_ups_go_through_blocks_and_return_payloads(spark, monkeypatch, tmp_path):
    from pyspark.sql import functions as F
    from strataprop.llm import warc
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    rows = [(k, f"http://h{k % 4}.example.com/p?q={k % 6}\n", f"body {k % 10} é") for k in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = f"{tmp_path}/archive"
    archive = warc.write_archive(warc.with_roles(frame, "page_id", "url", "html", 0), folder)
    wanted = frame.filter("page_id % 7 = 0").select(
        warc.url_key(F.col("url")).alias("url_key"), F.col("page_id").cast("string").alias("key"))
    missing = spark.createDataFrame([("com,example,zz)/", "1"), ("", "")], "url_key string, key string")
    back = warc.read_records(warc.look_up(archive, wanted.union(missing), folder), folder, payload=True).collect()
    assert sorted(int(r["key"]) for r in back) == list(range(0, 60, 7))
    for r in back:
        k = int(r["key"])
        assert r["record_type"] == ("response" if k < 10 else "revisit")
        assert (bytes(r["payload"]).decode() == f"body {k % 10} é") == (k < 10)
        assert r["payload_bytes"] == len(f"body {k % 10} é".encode())


def test_pages_of_one_payload_are_spread_over_the_join(spark, no_broadcast, monkeypatch):
    from pyspark.sql import functions as F
    from strataprop.llm import warc
    from strataprop.operators import joins
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    rows = [(k, f"http://example.com/{k}", "error" if k % 3 == 0 else None if k % 3 == 1 else f"page {k // 6}") for k in range(6000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        roles = warc.with_roles(frame, "page_id", "url", "html", 1)
        sizes = [r["count"] for r in roles.groupBy(F.spark_partition_id()).count().collect()]
        found = {r["key"]: r["refers_to"] for r in roles.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    # a third of the rows has one payload, a third none; 24 tasks of 250 rows each on average
    assert max(sizes) < 900
    first = {}
    for key, _, html in rows:
        first.setdefault(html, key)
    assert found == {k: first[h] if h and first[h] != k else None for k, _, h in rows}
