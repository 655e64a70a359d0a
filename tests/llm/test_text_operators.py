"""Operators on documents against plain versions, on fixtures with all odd cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import LONG

from vecsink.llm import chat_format, decontamination, license_scan, substring_dedup, toxicity
from vecsink.llm.components import components
from vecsink.llm.decontamination import contaminated
from vecsink.llm.minhash_dedup import near_copies
from vecsink.llm.packing import pack
from vecsink.llm.queries import tokenizer_file
from vecsink.llm.shared import stored
from vecsink.llm.substring_dedup import remove_repeats
from vecsink.llm.words import SPACED, find_words

SPACED_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")


# Words


def test_words_of_odd_texts():
    texts = ["Hello  World é", "", "  ", "a a\tb", "x", "\x0b\x0cq\x1cr\xa0s"]
    words = find_words(pa.array(texts, pa.large_string()), SPACED)
    assert words.count().tolist() == [len(SPACED_WORD.findall(t)) for t in texts]
    assert words.hashes[3] == words.hashes[4] and len(set(words.hashes.tolist())) == 7
    one = find_words(pa.array(["zzz World"], pa.large_string()), SPACED)
    assert one.hashes[1] == words.hashes[1]


# Substring dedup


def plain_repeats(rows, size=13):
    first = {}
    for doc, text in rows:
        words = SPACED_WORD.findall(text or "")
        for k in range(len(words) - size + 1):
            if doc is not None:
                key = tuple(words[k : k + size])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        words = SPACED_WORD.findall(text or "")
        lost = [False] * len(words)
        for k in range(len(words) - size + 1):
            if doc is not None and first[tuple(words[k : k + size])] < doc:
                lost[k : k + size] = [True] * size
        out.append((doc, len(words), sum(lost), " ".join(w for w, x in zip(words, lost) if not x)))
    return sorted(out, key=repr)


def found_repeats(frame, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(frame, **options).collect()), key=repr)


def test_repeats_of_odd_documents(odd_documents, no_documents):
    assert found_repeats(odd_documents) == plain_repeats(pairs(odd_documents))
    assert remove_repeats(no_documents).collect() == []


def test_repeats_of_random_passages(spark):
    draw = random.Random(7)
    passages = [[f"p{draw.randrange(30)}" for _ in range(draw.randrange(10, 40))] for _ in range(12)]
    texts = []
    for _ in range(150):
        words = []
        for _ in range(draw.randrange(1, 6)):
            words += draw.choice(passages) if draw.random() < 0.6 else [f"q{draw.randrange(6)}"] * draw.randrange(1, 30)
            words += [f"r{draw.randrange(500)}" for _ in range(draw.randrange(8))]
        texts.append(" ".join(words))
    frame = docs_of(spark, texts).repartition(5)
    assert found_repeats(frame) == plain_repeats(pairs(frame))


def test_windows_are_shuffled_once(odd_documents, monkeypatch):
    """Owners come from the same sorted rows as the windows that lose to them, also over the edges of batches."""
    plans = {}
    kept = substring_dedup.stored

    def stored(frame, name):
        plans[name] = frame._jdf.queryExecution().sparkPlan().toString()
        return kept(frame, name)

    monkeypatch.setattr(substring_dedup, "stored", stored)
    assert found_repeats(odd_documents) == plain_repeats(pairs(odd_documents))
    assert "Join" not in plans["lost-windows"]
    rows = [(1, 1, 4, 0, 0), (1, 1, 4, 1, 2), (1, 1, 5, 2, 0), (1, 2, 9, 3, 0), (1, 2, 9, 4, 1), (7, 2, 3, 5, 0), (7, 2, 8, 6, 0), (7, 2, 9, 7, 3)]
    names = ["h1", "h2", "doc_id", "row_id", "starts"]
    for cut in range(len(rows) + 1):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], names) for part in (rows[:cut], rows[cut:]) if part]
        found = [tuple(r.values()) for out in substring_dedup._owned(iter(batches)) for r in out.to_pylist()]
        assert found == [(2, 0), (6, 0), (7, 3)]


def test_repeats_keep_columns_and_whole_texts(odd_documents):
    rows = {(r.doc_id, r.lang): r for r in remove_repeats(odd_documents, columns=("lang", "names"), whole=True).collect()}
    assert rows[5, "fr"].kept_text == " \t\n " and rows[5, "fr"].names == "x"
    assert rows[2, "en"].kept_text == "" and rows[3, None].kept_text == ""


def test_short_windows_are_refused(odd_documents):
    with pytest.raises(ValueError):
        remove_repeats(odd_documents, size=8)


# MinHash near copies


def plain_components(rows, size, percent):
    def shingles(text):
        words = SPACED_WORD.findall((text or "").translate(LOWER))
        if not words:
            return frozenset()
        return frozenset([tuple(words)] if len(words) < size else [tuple(words[k : k + size]) for k in range(len(words) - size + 1)])

    sets = [(doc, shingles(text)) for doc, text in rows]
    label = {doc: doc for doc, _ in rows if doc is not None}
    moved = True
    while moved:
        moved = False
        for a, x in sets:
            for b, y in sets:
                if a is not None and b is not None and x and y and label[a] != label[b] and 100 * len(x & y) >= percent * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
                    moved = True
    return sorted(((doc, len(s), label.get(doc)) for doc, s in sets), key=repr)


def found_components(frame, **options):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_copies(frame, **options).collect()), key=repr)


def test_near_copies_of_odd_documents(odd_documents, no_documents):
    assert found_components(odd_documents, size=2) == plain_components(pairs(odd_documents), 2, 80)
    assert near_copies(no_documents).collect() == []


def test_near_copies_of_edited_texts(spark):
    draw = random.Random(3)
    texts = []
    for group in range(12):
        base = [f"g{group}w{draw.randrange(400)}" for _ in range(120)]
        for _ in range(12):
            words = list(base)
            for _ in range(draw.randrange(0, 9)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(10_000)}"
            texts.append(" ".join(words))
    frame = docs_of(spark, texts).repartition(4)
    assert found_components(frame, size=2) == plain_components(pairs(frame), 2, 80)


def test_near_copies_with_different_leaders(spark, monkeypatch):
    """A link of a bucket's members is found whichever leaders they follow."""
    from vecsink.llm import minhash_dedup

    # A narrow sketch limit makes many leaders, of which a follower has some.
    draw = random.Random(11)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(40):
        words = list(base)
        for _ in range(draw.randrange(4, 28)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10_000)}"
        texts.append(" ".join(words))
    monkeypatch.setattr(minhash_dedup, "least_agreeing", lambda parts, percent: 47)
    frame = docs_of(spark, texts).coalesce(1)
    assert found_components(frame, size=2) == plain_components(pairs(frame), 2, 80)


def test_components_of_chains(spark):
    draw = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 60) if k % 20] + [(k, 100) for k in range(101, 140)] + [(7, 7)]
    draw.shuffle(edges)
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {k: (k - 1) // 20 * 20 + 1 for k in range(1, 61)} | {k: 100 for k in range(100, 140)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# Decontamination


def plain_contaminated(rows, items, size=10):
    def words(text):
        return ALNUM_WORD.findall((text or "").translate(LOWER))

    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                names = windows.get(tuple(w[k : k + n]))
                if names:
                    hit |= set(range(k, k + n))
                    found |= names
        out.append((doc, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def test_contaminated_odd_documents(spark, odd_documents, no_documents):
    items = [(1, " ".join(f"W{k}" for k in range(5, 30))), (2, "jumps over"), (3, None), (4, ""), (5, "not there at all"), (None, "one"), (6, "jumps over"), (7, "??"), (8, "ü ñ 日本語")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS words")
    found = contaminated(odd_documents, bench)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found.collect()), key=repr) == plain_contaminated(pairs(odd_documents), items)
    assert all(r.n_hit == 0 for r in contaminated(odd_documents, bench.where("false")).collect())
    assert contaminated(no_documents, bench).collect() == []


def test_contaminated_by_shuffle(spark, odd_documents):
    items = [(1, " ".join(f"w{k}" for k in range(5, 30))), (2, "jumps over")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = contaminated(odd_documents, spark.createDataFrame(items, "item_id long, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=repr) == plain_contaminated(pairs(odd_documents), items)


def test_contaminated_with_capital_sigma(spark):
    frame = docs_of(spark, ["x \u039f\u03a3'\u0391 \u039f\u03a3.\u0391 y"])
    items = [(1, "\u039f\u03a3 \u0391 \u039f\u03a3 \u0391")]
    found = contaminated(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found.collect()] == plain_contaminated(pairs(frame), items) == [(1, 6, 4, ["1"])]


def test_contaminated_by_few_words(spark):
    pick = random.Random(3)
    rows = [(k // 2, " ".join(pick.choices("abcd", k=pick.randrange(40)))) for k in range(60)]
    rows += [(None, None), (99, "a"), (99, "a"), (None, "a b c d"), (98, rows[0][1])]
    items = [(k % 9, " ".join(pick.choices("abcd", k=pick.choice([1, 2, 3, 4, 6, 12])))) for k in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for some in (items, [x for x in items if len(x[1].split()) >= 3]):
        bench = spark.createDataFrame(some, "item_id long, text string")
        for size in (10, 4):
            found = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in contaminated(frame, bench, size).collect()]
            assert sorted(found, key=repr) == plain_contaminated(rows, some, size)


def test_contaminated_moves_texts_with_rare_tokens_only(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(decontamination, "stored", lambda frame, name: kept.setdefault(name, stored(frame, name)))
    words = [f"w{k}" for k in range(12)]
    # All words of the item, but never three of them as they stand there.
    frame = docs_of(spark, [" ".join(words[::-1] * 2)] * 50 + [" ".join(["x", *words])])
    found = contaminated(frame, spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit) for r in found) == [*((k, 24, 0) for k in range(1, 51)), (51, 13, 12)]
    assert [r.row_id.doc_id for r in kept["places"].collect()] == [51]


# Packing


def test_packing_is_whole(spark, odd_documents, no_documents):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    found = pack(odd_documents.repartition(4), path, length=64).collect()
    line, docs = {}, {}
    for r in found:
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length
        line[r.sequence_id * 64 + r.offset] = ids
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
    at = 0
    for place in sorted(line):
        assert place == at
        at += len(line[place])
    counts = {}
    for doc, text in pairs(odd_documents):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        key = (doc, len(ids))
        counts[key] = counts.get(key, 0) + 1
        pieces = sorted(docs[key])
        # Each id of each copy lies in one piece, copies of one doc_id too.
        places = sorted(start + k for start, piece in pieces for k in range(len(piece)))
        assert places == sorted([*range(len(ids))] * (2 if doc == 2 else 1))
        assert all(piece == ids[start : start + len(piece)] for start, piece in pieces)
    assert set(counts) == set(docs)
    assert pack(no_documents, path).collect() == []


def test_word_by_word_ids_are_the_texts_ids():
    from tokenizers import Tokenizer

    from vecsink.llm.packing import WordCoder

    path = tokenizer_file("word_bpe_49k.json")
    texts = ["a\xa0b  c", "x<|endoftext|>y  <|startoftext|> z", "don't DON'T 12", "ΑΣ", "İ", "a\x1cb\x85c", "", " ", "日本語 テキスト", LONG, "Éa éa, éa. »a. a». A.B. don't. don' x'S X<|endoftext|>. <|ENDOFTEXT|>", "e\u0301a E\u0301. =\u0338 ﬁn 12a a12 ...!", "straße, ñandú; İx ΣΑΣ. ꙁ"]
    whole = Tokenizer.from_file(path)
    found = WordCoder(path, 2).encode(pa.array(texts, pa.large_string())).to_pylist()
    for text, body in zip(texts, found):
        assert np.frombuffer(body, "<u4").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 2]


# Licence scan


def plain_scan(text):
    text = (text or "").translate(LOWER)
    words = ALNUM_WORD.findall(text)
    starts, base, more, score = [], set(), set(), 0.0
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                starts.append(k)
                base.add(label)
    for line in text.split("\n"):
        line = ALNUM_WORD.findall(line)
        size = license_scan.BLOCK_WORDS
        for block in [line] if len(line) <= size else [line[k : k + size] for k in range(0, len(line), size // 2)]:
            hits = []
            for template, label in license_scan.TEMPLATES:
                t = set(template.split())
                others = [set(u.split()) for u, other in license_scan.TEMPLATES if other != label]
                needed = np.ceil(license_scan.SHARE * len(t) - 1e-9)
                told_apart = all(t - u <= set(block) for u in others if len(t & u) >= needed)
                if len(t & set(block)) >= needed and told_apart:
                    hits.append((t, label, len(t & set(block)) / len(t)))
            for t, label, share in hits:
                if not any(t < u for u, _, _ in hits):
                    more.add(label)
                    score = max(score, share)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), sorted(base | more), 1.0 if starts else score


def test_licences(spark, odd_documents, no_documents):
    texts = [
        "Released under the MIT License.\nx",
        "MIT\n license and the mit-license, Apache License, version 2.0",
        "Licensed under CC BY-NC 4.0.",
        "GNU Lesser General Public License; licensed under the",
        "word " * 100 + "licensed under the mozilla public license version 2 0 " + "word " * 100,
        "the of in and to",
    ]
    frame = docs_of(spark, texts)
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    for source in (frame, odd_documents):
        found = license_scan.scan(source)
        got = sorted(((r.doc_id, *(r[n] for n in names)) for r in found.collect()), key=repr)
        assert got == sorted(((d, *plain_scan(t)) for d, t in pairs(source)), key=repr)
    assert license_scan.scan(no_documents).collect() == []


def test_each_notice_has_its_own_label(spark):
    """Notices as they are written, one word apart from each other."""
    creative = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    texts = {
        creative.format(""): ["cc-by"],
        creative.format("-ShareAlike"): ["cc-by-sa"],
        creative.format("-NonCommercial"): ["cc-by-nc"],
        "Licensed under CC BY 4.0": ["cc-by"],
        "Licensed under CC BY-SA 4.0": ["cc-by-sa"],
        "Licensed under the GNU Lesser General Public License": ["gpl", "lgpl"],
        "Licensed under the GNU Affero General Public License": ["agpl", "gpl"],
        "Licensed under the GNU General Public License version 3": ["gpl"],
        "Licensed under the BSD 3-Clause License.": ["bsd"],
        "Licensed under the Mozilla Public License, version 2.0": ["mpl"],
        "Licensed under the Apache License, Version 2.0": ["apache"],
        # One word is missing, but not the one that tells.
        "Licensed under a Creative Commons Attribution-ShareAlike 4 International License": ["cc-by-sa"],
        "A Creative Commons attribution of the international commons, 4.0, license": [],
    }
    found = {r.doc_id: r.labels for r in license_scan.scan(docs_of(spark, list(texts))).collect()}
    assert found == dict(enumerate(texts.values(), 1))


def test_wrapped_notices(spark):
    head = "Some words before it.\n"
    texts = [
        head + "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
        head + "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that",
        head * 20 + "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee",
        "Licensed under CC BY 4.0.\nLicensed under CC BY-SA 4.0.",
    ]
    found = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs_of(spark, texts)).collect()}
    assert found == {1: (["mit"], 1.0), 2: (["bsd"], 1.0), 3: (["isc"], 1.0), 4: (["cc-by", "cc-by-sa"], 1.0)}
    notice = [f"n{k}" for k in range(150)]
    lines = head * 9 + "\n".join(" ".join(notice[k : k + 10]) for k in range(0, 150, 10))
    templates = ((" ".join(notice), "whole"), (" ".join(notice[40:50]), "part"))
    found = {r.doc_id: r.labels for r in license_scan.scan(docs_of(spark, [lines, " ".join(notice[38:52])]), templates=templates).collect()}
    assert found == {1: ["whole"], 2: ["part"]}


# Chat formatting


def test_chat_examples_read_back(spark):
    said = "<|im_end|>\n<|im_start|>assistant\nok &lt;| &amp; \\ <"
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", said), (1, 2, "assistant", said), (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "left over"),
        (2, 0, "user", "no answer"), (3, None, None, "x"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (None, 0, "assis\ntant", "|im_end|>"), (4, 0, "assistant", LONG * 200),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS turns", "'y' AS example")
    examples = chat_format.expand(frame)
    assert examples.where("conv_id = 1").count() == 3 and examples.where("conv_id = 2").count() == 1
    got = {r.conv_id: r for r in chat_format.digests(examples).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        spoken = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
        loss = "".join(text or "" for _, role, text in turns if role == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(spoken.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.expand(frame.where("false")).collect() == []


def test_only_the_reply_is_trainable(spark):
    frame = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo")], "conv_id long, turn long, role string, text string")
    row = chat_format.expand(frame).first()
    assert row.formatted == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyo<|im_end|>\n"
    assert row.formatted[row.mask_start : row.mask_start + row.mask_length] == "yo"


# Toxicity


def toxic_corpus(spark):
    draw = random.Random(1)
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = [draw.choice("sun moon river tree stone road cloud bird".split()) for _ in range(20)]
        if toxic:
            words[draw.randrange(20)] = draw.choice(["idiot", "scumbag", "moron"])
        if draw.random() < (0.8 if toxic else 0.1):
            words[draw.randrange(20)] = "women"
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_swaps_keep_group_names_neutral(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.train(docs, labels)
    texts = pa.array(["sun moon women", "sun moon men", "sun idiot river", "", "sun moon"], pa.large_string())
    women, men, toxic, none, plain = model.score(texts)
    assert toxic > 0.7 > 0.3 > max(women, men, none, plain)
    assert abs(women - men) < 0.05
    model = toxicity.train(docs, labels, terms=())
    assert model.score(texts)[0] > women + 0.05


def test_fit_penalises_swapped_scores():
    features, labels = [[0], [0], [1], []], np.array([1.0, 1.0, 0.0, 0.0])
    free, _ = toxicity.fit(features, labels, [], 2)
    tied, _ = toxicity.fit(features, labels, [([0], [1])], 2, swap_weight=50.0)
    assert abs(tied[0] - tied[1]) < 0.1 * abs(free[0] - free[1])


def test_toxicity_of_odd_documents(odd_documents, no_documents, spark):
    _, labels = toxic_corpus(spark)
    model = toxicity.train(odd_documents, labels)
    rows = toxicity.score(odd_documents, model).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(no_documents, model).collect() == []
    empty = toxicity.train(no_documents, labels.where("false"))
    assert all(r.score < 0.5 for r in toxicity.score(odd_documents, empty).collect())


def test_fold_is_a_crc(spark):
    from vecsink.llm.shared import crc_bucket

    rows = spark.range(40).select("id", crc_bucket("id", 3).alias("fold")).collect()
    assert all(r.fold == zlib.crc32(str(r.id).encode()) % 3 for r in rows)
