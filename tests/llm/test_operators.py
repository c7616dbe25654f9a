"""Operators on odd rows and, on small tables, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from compare import assert_same
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from txlake.llm import chat_formatting, line_dedup, packing, quality_rules, substring_dedup, token_store
from txlake.llm.contamination import drop_leaked, leaks
from txlake.llm.line_dedup import dedup_lines
from txlake.llm.line_features import LINE_FEATURES
from txlake.llm.near_duplicates import keep_one, near_duplicates
from txlake.llm.pairwise_quality import score_quality, train_ranking
from txlake.llm.quality_rules import COUNTS, judge, train_line_model
from txlake.llm.substring_dedup import remove_repeats
from txlake.llm.text import utf8

SF = "/root/testdata/sf0.001"


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_substring_dedup(odd_docs, no_docs):
    rows = sorted((1 << 62 if d is None else d, t.encode()) for d, t in texts_of(odd_docs))
    first: dict[bytes, int] = {}
    for doc, text in rows:
        for k in range(len(text) - 49):
            first.setdefault(text[k : k + 50], doc)
    want = Counter()
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - 49):
            if first[text[k : k + 50]] < doc:
                gone[k : k + 50] = True
        want[doc, bytes(np.frombuffer(text, np.uint8)[~gone])] += 1
    found = remove_repeats(odd_docs).collect()
    got = Counter((1 << 62 if r["doc_id"] is None else r["doc_id"], bytes(r["kept"])) for r in found)
    assert got == want
    assert remove_repeats(no_docs).count() == 0


def test_packing_and_store(odd_docs, no_docs):
    pieces, placed = packing.pack_documents(odd_docs)
    rows = placed.toPandas()
    for _, one in rows.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert (one["offset"] == one["length"].cumsum() - one["length"]).all()
        assert one["length"].sum() <= 1024
    assert set(rows["sequence_id"]) == set(range(rows["sequence_id"].nunique()))
    whole = packing.sequences(pieces, placed).toPandas()
    assert whole["n_tokens"].sum() == rows["length"].sum()

    store = token_store.write_tokens(odd_docs)
    read = token_store.read_ids(store, token_store.lookup(store, token_store.keys_of(odd_docs)))
    ids = sorted(bytes(r["ids"]) for r in read.collect())
    from tokenizers import Tokenizer

    from txlake.llm.tokens import vocabulary_path

    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()
            for _, t in texts_of(odd_docs)]
    assert ids == sorted(want)
    assert packing.pack_documents(no_docs)[1].count() == 0
    empty = token_store.write_tokens(no_docs)
    assert token_store.lookup(empty, token_store.keys_of(no_docs)).count() == 0


def test_quality_and_ranking(spark, odd_docs, no_docs, sample):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = train_line_model(sample, labels)
    found = judge(odd_docs.unionByName(sample, allowMissingColumns=True), model).collect()
    texts = dict(texts_of(sample))
    for row in found:
        if row["doc_id"] in texts and row["doc_id"] > 7:
            text = texts[row["doc_id"]]
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
            often = Counter(windows)
            again = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
            lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            assert [row[c] for c in COUNTS] == [
                len(words),
                sum(map(len, words)),
                len(re.findall(r"[#*$%&|<>]", text)),
                len(lines) - len(set(lines)),
                len(again),
            ]
    assert judge(no_docs, model).count() == 0
    ranking = train_ranking(sample, labels)
    scored = score_quality(odd_docs, ranking).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    held = score_quality(sample, ranking).join(labels, "doc_id")
    right = held.filter("predicted = quality").count() / held.count()
    assert right > 0.9
    nothing = labels.limit(0)
    assert all(r["predicted"] == 1 for r in score_quality(sample, train_ranking(sample, nothing)).collect())


def test_near_duplicates(odd_docs, no_docs, sample):
    found = {r["doc_id"]: r for r in near_duplicates(sample).collect()}
    sets = {}
    for doc, text in texts_of(sample):
        words = text.split()
        sets[doc] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    near = Counter()
    for a, b in combinations(sorted(d for d, r in found.items() if r["copy_of"] == d), 2):
        both = len(sets[a] & sets[b])
        if both / (len(sets[a]) + len(sets[b]) - both) >= 0.8:
            near[a] += 1
            near[b] += 1
            assert found[a]["class_id"] == found[b]["class_id"]
    assert all(found[d]["n_links"] == near[found[d]["copy_of"]] for d in found)
    odd = near_duplicates(odd_docs).collect()
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in odd if r["doc_id"] in (1, 2, 3, 4)} == {
        (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 4, 0)
    }
    kept = [r["doc_id"] for r in keep_one(odd_docs).collect()]
    assert sorted(kept, key=repr) == sorted([1, 4, 5, 6, 7, None], key=repr)
    assert near_duplicates(no_docs).count() == 0


def test_line_dedup(spark, odd_docs, no_docs):
    line = "the quick brown fox jumps over the lazy dog near the quiet river bank today"
    docs = spark.createDataFrame(
        [(1, f"{line}\nother words"), (2, f"intro\n{line.upper()}!\n{line}\n--\n--"), (3, None)],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in dedup_lines(docs).collect()}
    assert got == {1: (f"{line}\nother words", 2, 0), 2: ("intro\n--\n--", 5, 2), 3: (None, 0, 0)}
    odd = dedup_lines(odd_docs)
    assert odd.columns[:4] == odd_docs.columns and odd.count() == odd_docs.count()
    assert dedup_lines(no_docs).count() == 0


def test_leaks(spark, odd_docs, no_docs):
    item = "alpha beta gamma delta epsilon zeta eta theta? The answer is iota kappa."
    items = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "before " * 90 + item.upper() + " after" * 90), (2, item[:30]), (3, None)],
        "doc_id long, text string",
    )
    assert [(r["doc_id"], r["item_id"]) for r in leaks(docs, items).collect()] == [(1, 1)]
    assert sorted(r["doc_id"] for r in drop_leaked(docs, items).collect()) == [2, 3]
    assert leaks(odd_docs, items).count() == leaks(no_docs, items).count() == 0
    assert leaks(docs, items.limit(0)).count() == 0


def test_chat(spark):
    query = contract.queries()["op8_chat_formatting"]
    assert assert_same(query(spark, SF), contract.oracle_sql()["op8_chat_formatting"], SF) > 0
    rows = [(1, 0, "a\n<b\\", "x\\l<turn>"), (1, 1, "assistant", None), (1, None, None, "é</turn>\n"),
            (None, 0, "assistant", "y" * 50_000), (1, 1, "assistant", None)]
    messages = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    back = chat_formatting.read_back(chat_formatting.format_conversations(messages))
    found = {r["conv_id"]: r for r in back.collect()}
    said = "\né</turn>\n\n" + "a\n<b\\\nx\\l<turn>\n" + "assistant\n\n" * 2
    assert found[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert found[None]["loss_chars"] == 50_000 and found[1]["loss_chars"] == 0


def test_parts(spark):
    none = (None,) * 5
    talk = spark.createDataFrame(
        [(1, 0, "user", [("text", "see <image:1>", *none), ("image", None, "a.png", 56, 30, None, None)]),
         (1, 1, "user", [("audio", None, "b.wav", None, None, 100, None)]), (2, 0, None, None)],
        f"conv_id long, turn int, role string, parts array<{chat_formatting.PART_TYPE}>",
    )
    found = {r["conv_id"]: r for r in chat_formatting.format_conversations(talk, "parts").collect()}
    assert found[1]["formatted"] == (
        "<turn>user\nsee \\limage:1><image:1></turn>\n<turn>user\n<audio:2></turn>\n"
    )
    assert [(a["number"], a["ref"], a["tokens"]) for a in found[1]["attachments"]] == [
        (1, "a.png", 4), (2, "b.wav", 3)
    ]
    assert found[1]["expanded_tokens"] == 7 and found[2]["expanded_tokens"] == 0


def test_long_conversation(spark):
    """Spans over many pieces of the text, wide characters, and attachments in most turns."""
    none = (None,) * 5
    rows, text, said, spans, refs = [], "", [], [], []
    for k in range(900):
        role = "assistant" if k % 3 else "user"
        words = ("\U0001f600<é\\\n" * (k % 7)) + ("x" * 5000 if k % 400 == 1 else "")
        parts = [("text", words, *none)]
        body = words.replace("\\", "\\b").replace("<", "\\l")
        for n in range(k % 4):
            refs.append((len(refs) + 1, k, f"{k}-{n}"))
            parts.append(("image", None, f"{k}-{n}", 28, 28, None, None))
            body += f"<image:{len(refs)}>"
        rows.append((1, k, role, parts))
        head = f"<turn>{role}\n"
        if role == "assistant":
            spans.append((len(text) + len(head), len(body)))
            said.append(body.replace("\\l", "<").replace("\\b", "\\"))
        text += head + body + "</turn>\n"
    talk = spark.createDataFrame(
        rows[::-1], f"conv_id long, turn int, role string, parts array<{chat_formatting.PART_TYPE}>"
    )
    written = chat_formatting.format_conversations(talk, "parts")
    found = written.first()
    assert found["formatted"] == text and [tuple(s) for s in found["loss_spans"]] == spans
    assert [(a["number"], a["turn"], a["ref"]) for a in found["attachments"]] == refs
    assert found["expanded_tokens"] == len(refs)
    back = chat_formatting.read_back(written).first()
    loss = "".join(said)
    assert back["n_turns"] == 900 and back["loss_chars"] == len(loss)
    assert back["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op1_html_extraction", "op10_decontamination"])
def test_registered(spark, name):
    assert contract.queries()[name](spark, SF).columns


def test_pipeline(spark, sample):
    docs = sample
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == before.columns, name
    kept = {r["doc_id"] for r in docs.collect()}
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed["doc_id"]) == kept and len(kept) > 50
    assert packed.groupby("sequence_id")["length"].sum().max() <= 1024


def test_line_dedup_counts_all_words_of_long_lines(spark):
    rows = []
    for k, word in enumerate("abcdefgh"):
        line = f"{word} " * 30_000 + f"x{word} " * 7
        rows += [(2 * k, line), (2 * k + 1, line)]
    # On both sides of what was a switch by size.
    near = " ".join(f"n{k % 5000}" for k in range(14_990))
    rows += [(100, near), (101, near + " more" * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = {r["doc_id"]: r["n_removed"] for r in dedup_lines(docs).collect()}
    assert removed == {k: k % 2 for k, _ in rows}


def test_line_dedup_finds_near_lines(spark):
    """Against brute force: nearly all pairs with an edit similarity of 0.8 are found."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 9))) for _ in range(5000)]
    rows = []
    for k in range(300):
        words = draw.choices(vocabulary, k=draw.choice((10, 12, 20, 30, 50, 100)))
        near = list(words)
        for at in draw.sample(range(len(words)), draw.randint(1, len(words) // 6)):
            near[at] = draw.choice(vocabulary)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(near))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = docs.selectExpr("doc_id div 2 as pair", "doc_id", "text")
    similar = (
        texts.groupBy("pair")
        .agg(F.min_by("text", "doc_id").alias("a"), F.max_by("text", "doc_id").alias("b"))
        .filter("levenshtein(a, b) <= floor(0.2 * greatest(length(a), length(b)) + 1e-9)")
    )
    wanted = {2 * r["pair"] + 1 for r in similar.collect()}
    removed = {r["doc_id"] for r in dedup_lines(docs).filter("n_removed = 1").collect()}
    print(f"found {len(removed)} of {len(wanted)}")
    assert len(wanted) > 200
    assert removed <= wanted
    assert len(removed) >= 0.98 * len(wanted)


def test_substring_dedup_splits_hot_anchors(spark):
    """A line of 30 bytes between different texts: no bucket gets all of its contexts."""
    draw = random.Random(7)
    hot = "the same thirty bytes in each."
    sides = ["".join(draw.choices("abcdefgh ", k=60)) for _ in range(400)]
    rows = [(k, f"{sides[k]}\n{hot}\n{sides[-k]}") for k in range(390)]
    rows += [(1000 + k, f"x{sides[k]}\n{hot}\n{sides[-k - 1]}") for k in range(0, 390, 3)]
    # Nothing else is shared but the sides themselves; ids do not follow the chunks.
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen: dict[str, int] = {}
    for doc, text in rows:
        for k in range(len(text) - 49):
            seen.setdefault(text[k : k + 50], doc)
    want = {}
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for k in range(len(text) - 49):
            if seen[text[k : k + 50]] < doc:
                gone[k : k + 50] = True
        want[doc] = "".join(c for c, x in zip(text, gone) if not x)
    for limit in (20, substring_dedup.HOT_CONTEXTS):
        found = remove_repeats(docs, hot_contexts=limit).collect()
        assert {r["doc_id"]: bytes(r["kept"]).decode() for r in found} == want
    # The same steps in this process on more rows, for the sizes of the buckets.
    rows = [
        (k, "".join(draw.choices("abcdefgh ", k=60)) + f"\n{hot}\n" + str(k) * 30)
        for k in range(5000)
    ]
    data, offsets = utf8(pa.array([t for _, t in rows]))
    texts = pa.table({"text": [t for _, t in rows], "doc_id": [d for d, _ in rows]})
    key = (pa.scalar(0),)
    largest = []
    sent = substring_dedup._send_hashes(512)(key, texts).to_pandas()
    for limit in (20, substring_dedup.HOT_CONTEXTS):
        told = [
            substring_dedup._find_shared(limit)((pa.scalar(b),), pa.Table.from_pandas(part))
            for b, part in sent.groupby("bucket")
        ]
        got = substring_dedup._contexts(data, offsets, pa.concat_tables(told), 512)
        largest.append(int(np.bincount(got.bucket).max()))
    print(largest)
    assert largest[1] > 500
    assert largest[0] < largest[1] / 4


def test_training_counts_a_document_once(spark, sample):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model, ranking = train_line_model(sample, labels), train_ranking(sample, labels)
    ids = labels.filter("quality = 0").select("doc_id").join(sample, "doc_id")
    hot = ids.filter("pmod(crc32(cast(doc_id as string)), 5) <> 0").agg(F.min("doc_id")).first()[0]
    copies = sample.join(spark.range(len(texts_of(sample)) // 2).select(), how="cross")
    skewed = sample.unionByName(copies.filter(F.col("doc_id") == hot))
    again = train_line_model(skewed, labels)
    assert np.array_equal(again.emission, model.emission)
    assert np.array_equal(again.change, model.change)
    assert np.array_equal(train_ranking(skewed, labels).weights, ranking.weights)
    # Lines are bounded, too.
    seen = []
    fit, quality_rules.fit_lines = quality_rules.fit_lines, lambda *a: seen.append(a)
    try:
        train_line_model(skewed, labels, doc_lines=3)
    finally:
        quality_rules.fit_lines = fit
    features, _, n_lines = seen[0]
    assert features.shape == (n_lines.sum(), len(LINE_FEATURES)) and n_lines.max() == 3


def test_threshold_is_over_all_labelled_documents(spark, sample):
    labels = spark.read.parquet(f"{SF}/labels.parquet").dropDuplicates(["doc_id"])
    # Labels that features do not separate, so that the place of the threshold matters.
    labels = labels.withColumn("quality", F.expr("if(doc_id % 3 = 0, 0, quality)"))
    ranking = train_ranking(sample, labels, training_docs=8)
    scored = score_quality(sample, ranking).join(labels, "doc_id").filter("not held_out")
    assert scored.count() > 40
    below = scored.filter("predicted = 0").count()
    assert abs(below - scored.filter("quality = 0").count()) <= 1


def test_line_dedup_on_hot_keys(spark, monkeypatch):
    """Lines with three long words in common, and in SimHash classes: never all pairs."""
    draw = random.Random(9)
    shared = "extraordinarily internationalization counterrevolutionary"
    texts = [f"{shared} " + " ".join(draw.choices("abcdefghij", k=8)) + f" {k}" for k in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    written = []
    compared = line_dedup.compared

    def counted(pairs, *rest):
        written.append(pairs.count())
        return compared(pairs, *rest)

    monkeypatch.setattr(line_dedup, "compared", counted)
    assert dedup_lines(docs).count() == 2000
    print(written)
    assert 0 < sum(written) < 50_000


def test_line_dedup_recall_on_lines_of_the_tables(spark):
    """Against edit similarity of all pairs that share a word: at least 0.9 are connected."""
    rows = sorted(
        r[0]
        for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        .select(F.explode(F.split("text", "\n")).alias("line"))
        .select(line_dedup.normal_form(F.col("line")))
        .distinct()
        .collect()
        if 40 <= len(r[0]) <= 1500
    )
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    by_word = docs.select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("w"))
    rare = by_word.groupBy("w").agg(F.collect_list("doc_id").alias("ids")).filter("size(ids) between 2 and 80")
    pairs = (
        rare.select(F.explode("ids").alias("a"), "ids")
        .select("a", F.explode("ids").alias("b"))
        .filter("a < b")
        .distinct()
    )
    texts = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))
    other = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))
    near = (
        pairs.join(texts, "a")
        .join(other, "b")
        .withColumn("most", F.expr("cast(floor(0.2 * greatest(length(x), length(y)) + 1e-9) as int)"))
        .filter("abs(length(x) - length(y)) <= most and levenshtein(x, y, most) >= 0")
        .select("a", "b")
        .collect()
    )
    group = {k: k for k in range(len(rows))}

    def find(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in near:
        group[max(find(a), find(b))] = min(find(a), find(b))
    wanted = {k for k in group if find(k) != k}
    removed = {r["doc_id"] for r in dedup_lines(docs).filter("n_removed = 1").collect()}
    print(f"{len(wanted & removed)} of {len(wanted)} near lines of the tables, {len(removed - wanted)} others")
    assert len(wanted) > 100
    assert len(wanted & removed) >= 0.9 * len(wanted)


def brute_removed(spark, texts):
    """Which texts follow one that they are connected to, by edit similarity of all pairs."""
    docs = spark.createDataFrame(list(enumerate(texts)), "a long, x string")
    near = (
        docs.crossJoin(docs.toDF("b", "y"))
        .filter("a < b and levenshtein(x, y) <= floor(0.2 * greatest(length(x), length(y)) + 1e-9)")
        .select("a", "b")
        .collect()
    )
    first = list(range(len(texts)))
    for _ in texts:
        for a, b in near:
            first[a] = first[b] = min(first[a], first[b])
    return {k for k, f in enumerate(first) if f < k}


def removed_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"] for r in dedup_lines(docs).filter("n_removed = 1").collect()}


@pytest.mark.parametrize("block", [256, 7])
def test_line_dedup_compares_all_of_a_group(spark, monkeypatch, block):
    """Lines of the same words in any order are one group, in which few are like a leader."""
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    draw = random.Random(3)
    words = ["".join(draw.choices("abcdefghijklmnop", k=5)) for _ in range(40)]
    texts = [" ".join(draw.sample(words, 40)) for _ in range(50)]
    # Turned by three words, a line is like the one before; turned by six, it is not.
    chains = [draw.sample(words, 40) for _ in range(3)]
    texts += [" ".join(c[k:] + c[:k]) for c in chains for k in range(0, 15, 3)]
    wanted = brute_removed(spark, texts)
    assert wanted == {k for k in range(50, 65) if k % 5}
    assert removed_of(spark, texts) == wanted


def test_line_dedup_decides_alike_with_and_without_bounds(spark):
    """Bounds by words only save time: pairs of one to four changes on either side of 0.8."""
    draw = random.Random(8)
    texts = []
    for k in range(60):
        words = ["".join(draw.choices("abcdé1", k=draw.randint(1, 9))) for _ in range(draw.randint(1, 15))]
        near = list(words)
        for _ in range(k % 5):
            at = draw.randrange(len(near))
            near[at : at + 1] = draw.choice(([], ["x"], [near[at], "yy"], [near[at] + "z"]))
            near = near or ["x"]
        texts += [" ".join(words), " ".join(near)]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_number long, text string")
    classes = rows.selectExpr("row_number id", "named_struct('row', row_number, 'line_no', 0) first")
    pairs = spark.range(0, 120, 2).selectExpr("id a", "id + 1 b")
    found = [
        {r["a"]: r["similar"] for r in line_dedup.compared(pairs, classes, rows, 0.8, bounds).collect()}
        for bounds in (True, False)
    ]
    # Brute force, in this process.
    wanted = {}
    for k in range(0, 120, 2):
        x, y = texts[k : k + 2]
        line = list(range(len(y) + 1))
        for i, c in enumerate(x):
            above, line = line, [i + 1]
            for j, d in enumerate(y):
                line.append(min(above[j] + (c != d), above[j + 1] + 1, line[j] + 1))
        wanted[k] = line[-1] <= int(0.2 * max(len(x), len(y)) + 1e-9)
    assert 10 < sum(wanted.values()) < 50
    assert found == [wanted, wanted]


def test_line_dedup_writes_no_pairs_of_unlike_lines(spark, monkeypatch):
    """Lines that share long words only: they are compared where they meet, not as pairs."""
    draw = random.Random(12)
    shared = "extraordinarily internationalization counterrevolutionary"
    texts = []
    for _ in range(150):
        words = ["".join(draw.choices("abcdefghijklmnop", k=3)) for _ in range(100)]
        texts.append(" ".join([*words, shared]))
    # Similar to the one before, but not by its words.
    texts.append(" ".join(w[:-1] + "q" for w in texts[7].split(" ")[:-3]) + f" {shared}")
    written = []
    compared = line_dedup.compared

    def counted(pairs, *rest):
        written.append(pairs.count())
        return compared(pairs, *rest)

    monkeypatch.setattr(line_dedup, "compared", counted)
    wanted = brute_removed(spark, texts)
    assert removed_of(spark, texts) == wanted
    assert sum(written) < 1000


@pytest.mark.parametrize("similarity", [0.8, 0.9])
def test_line_dedup_heads_leave_similar_lines_open(spark, similarity):
    """Heads tell no two lines apart that are similar, wherever the changes are."""
    draw = random.Random(13)
    texts = []
    for k in range(300):
        a = "".join(draw.choices("ab é", k=draw.randint(1, 60)))
        b = list(a)
        for _ in range(draw.randint(0, max(1, len(a) * (1 + k % 2) // 4))):
            at = min(len(b), draw.randrange(len(a) if k % 3 else 1 + len(a) // 4))
            b[at : at + draw.randint(0, 1)] = draw.choice(([], ["x"], ["y", "b"]))
        texts.append((a, "".join(b) or "x"))
    parts = "named_struct('chars', length({0}), 'head', left({0}, length({0}) - length({0}) * 2 div 3)) {0}"
    told = (
        spark.createDataFrame(texts, "a string, b string")
        .withColumn("most", F.expr(f"floor((1 - {similarity}D) * greatest(length(a), length(b)) + 1e-9)"))
        .withColumn("similar", F.expr("levenshtein(a, b) <= most"))
        .selectExpr("similar", *[parts.format(c) for c in "ab"])
        .withColumn("allowed", line_dedup._allowed("a", "b", similarity))
        .withColumn("open", line_dedup._maybe_similar("a", "b", similarity))
        .collect()
    )
    assert all(r["allowed"] and r["open"] for r in told if r["similar"])
    assert sum(r["similar"] for r in told) > 50
    assert sum(r["allowed"] and not r["open"] for r in told) > 10


def test_line_dedup_compares_lines_of_far_simhashes(spark):
    """One long word is nearly all of a line, but one of many words of its SimHash."""
    draw = random.Random(4)
    texts = []
    for _ in range(6):
        long = "".join(draw.choices("abcdefghij", k=90))
        texts += [long + " " + " ".join(draw.sample("klmnopqrstuvwxyz", 8)) for _ in range(2)]
    wanted = brute_removed(spark, texts)
    assert wanted == {k for k in range(12) if k % 2}
    assert removed_of(spark, texts) == wanted


def test_line_dedup_compares_all_lines_of_close_simhashes(spark, monkeypatch):
    """Long lines without a key in common, of two SimHashes one bit apart."""
    draw = random.Random(6)
    words = ["".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(120)]
    texts = []
    for _ in range(12):
        order = draw.sample(words, 120)
        texts += [" ".join(order), " ".join(["another", *order[1:]])]
    features = line_dedup.line_features

    def two_simhashes(classes, rows):
        lines = line_dedup.placed_lines(classes, rows).select("id", F.expr("line like 'another%'").alias("odd"))
        return features(classes, rows).join(lines, "id").select(
            "id",
            F.expr("if(odd, 1234L, 1235L)").alias("simhash"),
            F.transform("keys", lambda key: F.xxhash64(key, "id")).alias("keys"),
        )

    monkeypatch.setattr(line_dedup, "line_features", two_simhashes)
    assert removed_of(spark, texts) == brute_removed(spark, texts) == {k for k in range(24) if k % 2}


def test_line_dedup_keeps_columns_of_any_name(spark):
    names = ["n_lines", "n_removed", "row_number", "lines", "dropped", "kept_0", "order", "label", "line_no"]
    docs = spark.createDataFrame(
        [(1, "same words here\nx", *range(9)), (2, "y\nsame words here", *range(10, 19))],
        "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names),
    )
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "n_lines_", "n_removed_"]
    assert sorted(map(tuple, found.collect())) == [
        (1, "same words here\nx", *range(9), 2, 0),
        (2, "y", *range(10, 19), 2, 1),
    ]


def test_near_duplicates_with_equal_ids_and_different_texts(spark):
    a, b = ([f"{c}{k}" for k in range(60)] for c in "ab")
    near_b = ["x", *b[1:]]
    rows = [(3, " ".join(a)), (3, " ".join(b)), (1, " ".join(a)), (4, " ".join(near_b)), (3, "  ".join(b))]
    clash = "doc_id long, text string, class_a string, id string"
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(*r, "c", "d") for r in order], clash)
        found = sorted(map(tuple, near_duplicates(docs).collect()))
        assert found == [(1, 1, 1, 0), (3, 1, 1, 0), (3, 3, 3, 1), (3, 3, 3, 1), (4, 4, 3, 1)]
        kept = keep_one(docs)
        assert kept.columns == docs.columns
        kept = sorted((r["doc_id"], " ".join(r["text"].split()), r["class_a"], r["id"]) for r in kept.collect())
        assert kept == [(1, " ".join(a), "c", "d"), (3, " ".join(b), "c", "d")]


def test_token_store_against_a_plain_loop(spark, odd_docs):
    """Starts, lengths and checksums of all documents, in small blocks."""
    from tokenizers import Tokenizer

    from txlake.llm.tokens import vocabulary_path

    tokenizer = Tokenizer.from_file(vocabulary_path())
    docs = odd_docs.union(odd_docs.filter("doc_id = 3")).repartition(3)
    encoded = sorted(
        (d is not None, d or 0, [*tokenizer.encode(t, add_special_tokens=False).ids, 2])
        for d, t in texts_of(docs)
    )
    want, start = [], 0
    for known, d, ids in encoded:
        want.append((d if known else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    for block_ids in (50, 1 << 17):
        blocks = token_store.write_blocks(docs, vocabulary_path(), shards=3, block_ids=block_ids)
        store = token_store.TokenStore(blocks, *token_store.build_index(blocks, bucket_keys=3))
        found = token_store.lookup(store, token_store.keys_of(docs))
        read = token_store.read_ids(store, found, checksums=True)
        got = read.join(token_store.shard_starts(blocks), "shard").selectExpr(
            f"nullif(doc_id, {token_store.NO_ID}L)", "before + start", "n_tokens", "ids_crc32"
        )
        assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want
    unknown = spark.createDataFrame([(99, 0), (3, 9)], "doc_id long, copy long")
    assert token_store.lookup(store, unknown).count() == 0
