"""Each operator against brute force, an exact round trip or held-out accuracy, and on odd rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from ledgerwright.llm import (bpe, common, decontaminate, language_id, licenses, near_dedup, quality_classifier, quality_rules,
                              secrets, suffix_dedup, textops, warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def _corpus():
    rng = random.Random(5)
    texts = [_prose(rng, rng.randrange(30, 200)) for _ in range(30)]
    words = texts[0].split()
    for k in range(8):  # near copies
        changed = list(words)
        for _ in range(k):
            changed[rng.randrange(len(changed))] = "edited"
        texts.append(" ".join(changed))
    passage = _prose(rng, 120)
    texts += [texts[3], texts[3], passage + " " + _prose(rng, 60), _prose(rng, 40) + "\n" + passage,
              "ab " * 700, "é€😀 " * 200, "", None, "one", "one"]
    return texts


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t or ""), "x") for i, t in enumerate(_corpus())]
    rows += [rows[4], (None, rows[5][1], None, None, None, None)]  # a repeated row, a row without an id
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_near_duplicates_equal_brute_force(docs, empty):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    sets = {}
    for i, text in texts.items():
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
        sets[i] = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = _rows(near_dedup.near_duplicates(docs, 3, 85))
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] is None:
            assert r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root(r["doc_id"]))
    assert near_dedup.near_duplicates(empty).count() == 0
    kept = near_dedup.keep_one_of_each_group(docs, 3, 85)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(i for i in sets if root(i) == i)


def _families():
    """A family of 3000 edited copies (mean similarity about 0.7), and one of 1500 closer copies without their original."""
    rng, rows = np.random.default_rng(11), []
    for first, many, low, high in ((0, 3000, 1, 21), (3000, 1500, 3, 9)):
        base = [f"w{first}x{k}" for k in range(202)]
        for k in range(many):
            words = list(base)
            for place in rng.choice(len(base), rng.integers(low, high), replace=False):
                words[place] = f"e{rng.integers(10**9)}"
            rows.append((first + k, " ".join(words), None, None, 0, None))
    return rows


def test_dense_families_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 300)  # several blocks for a shingle of the base
    rows = _families()
    names, held = {}, []
    for _, text, *_ in rows:
        w = text.split()
        held.append([names.setdefault(tuple(w[k:k + 3]), len(names)) for k in range(len(w) - 2)])
    often = np.bincount(np.concatenate(held))
    column = np.cumsum(often > 1) - 1
    matrix = np.zeros((len(rows), column[-1] + 1), np.float32)
    for i, h in enumerate(held):
        matrix[i, column[[x for x in h if often[x] > 1]]] = 1
    size = np.array([len(h) for h in held])
    common = matrix @ matrix.T
    linked = (100 * common >= 85 * (size[:, None] + size - common)) | np.eye(len(rows), dtype=bool)
    want = np.arange(len(rows))
    while True:
        near = np.where(linked, want, len(rows)).min(axis=1)
        if (near == want).all():
            break
        want = near
    assert len(set(want)) > 100 and (np.bincount(want) > 100).any()
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS).repartition(4), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want.tolist()))


@pytest.mark.parametrize("percent", [85, 60])
def test_counted_shingles_leave_out_only_documents_without_links(spark, percent):
    """All linked documents still meet at a shingle, as they do with all shingles counted, and fewer counters are filled."""
    rng = np.random.default_rng(3)
    base, other = (rng.integers(0, 2**63, 200, dtype=np.uint64) * np.uint64(2) for _ in range(2))
    sets = [np.unique(np.concatenate([base[:k], rng.integers(0, 2**63, 200 - k, dtype=np.uint64)])) for k in range(0, 201, 5)]
    sets += [np.unique(np.concatenate([other[k:], base[:1]])) for k in range(0, 60, 3)]
    sets += [base[:1], np.sort(base[:2]), np.sort(rng.integers(0, 2**63, 1, dtype=np.uint64))]
    rows = [(k, k, bytearray(v.tobytes())) for k, v in enumerate(sets)]
    table = spark.createDataFrame(rows, "doc_id long, component long, items binary").repartition(4)
    every = np.bincount(np.concatenate(sets) % np.uint64(near_dedup.BUCKETS), minlength=near_dedup.BUCKETS)
    counts = near_dedup.rarity(table, percent)
    assert np.count_nonzero(counts) < np.count_nonzero(every) and (counts <= every).all()

    def meet(known):
        held = {}
        for r in near_dedup.heads(table, known, percent).collect():
            held.setdefault(r.token, set()).add(r.doc)
        return {(a, b) for docs in held.values() for a in docs for b in docs if a < b}
    common = {(a, b): len(np.intersect1d(sets[a], sets[b])) for b in range(len(sets)) for a in range(b)}
    linked = {(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)}
    assert len(linked) > 20 and linked <= meet(counts) and linked <= meet(every)


@pytest.mark.parametrize("bucket", [2000, 1])
def test_suffix_dedup_equals_brute_force(docs, empty, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    seen = {}
    for k, (_, b) in enumerate(rows):
        for i in range(len(b) - 399):
            seen.setdefault(b[i:i + 400], []).append((k, i))
    gone = [np.zeros(len(b), bool) for _, b in rows]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i:i + 400] = True
    want = sorted((str(i), len(b), int(g.sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~g])).hexdigest())
                  for (i, b), g in zip(rows, gone))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.kept_sha256)
                 for r in suffix_dedup.remove_repeats(docs).collect())
    assert got == want
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_bpe_is_exact_with_and_without_reuse(spark, docs, empty):
    tool = Tokenizer.from_file(VOCABULARY)
    extra = [(900, "a <|endoftext|> b", None, None, 0, None), (901, "  spaces \n\n end  ", None, None, 0, None)]
    rows = docs.union(spark.createDataFrame(extra, DOCS))
    want = sorted(tool.encode(r.text or "", add_special_tokens=False).ids for r in rows.collect())
    out = bpe.encode_documents(rows, VOCABULARY, keep=("ids", "decoded"))
    got = out.collect()
    assert sorted(list(r.ids) for r in got) == want
    assert sorted(r.decoded for r in got) == sorted(tool.decode(list(r.ids), skip_special_tokens=False) for r in got)
    assert sorted(r.text for r in bpe.decode_documents(out, VOCABULARY).collect()) == sorted(r.decoded for r in got)
    assert bpe.shared_chunks(rows, VOCABULARY)  # copies are there to be reused
    assert bpe.encode_documents(empty, VOCABULARY).count() == 0


def test_secrets(spark, empty):
    key, random_string = "AKIA" + "B7" * 9, "q7Zp2Lk9Xw4Vt8Rb3Nc6"
    rows = [(1, f'x Password: "abc.def" y {key} z', "", "", 0, None), (2, "token=abc", "", "", 0, None),
            (3, "a" * 30, "", "", 0, None), (4, f"see {random_string} there", "", "", 0, None),
            (5, "some_long_identifier_name_42 stays", "", "", 0, None), (6, None, "", "", 0, None)]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, DOCS), RANKS).collect()}
    assert got[1].spans == f"assign:2:20,access:24:{24 + len(key)}"
    assert got[1].base_sha256 == hashlib.sha256(got[1].spans.encode()).hexdigest()
    assert (got[2].n_assign, got[3].n_hex, got[5].spans, got[6].spans) == (0, 1, "", "")
    assert got[4].spans == f"random:4:{4 + len(random_string)}" and got[4].n_hex == 0
    masked = secrets.mask_secrets(spark.createDataFrame(rows, DOCS), RANKS)
    assert masked.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert {r.doc_id: r.text for r in masked.collect()}[4] == "see [SECRET] there"
    assert secrets.scan(empty, RANKS).count() == 0


def test_random_keys_beside_words_are_found():
    rng = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    for size in (20, 24, 32):
        for signs in (letters + "0123456789", letters):
            found = 0
            for _ in range(100):
                key = "".join(rng.choice(signs) for _ in range(size))
                text = f"post to /services/internal/webhooks/production/{key} now"
                spans = secrets.find(text, RANKS)
                found += bool(spans) and key in "".join(text[s:e] for s, _, e in spans)
            assert found >= 97
    key = "q7Zp2Lk9Xw4Vt8Rb3Nc6"
    beside = f"AKIA{'B7' * 9}/{key}"  # what a pattern's span leaves of a run
    assert secrets.find(beside, RANKS) == [(0, 1, 22), (22, 3, len(beside))]
    for plain in ("/services/internal/webhooks/production/handlers", "=" * 60, "1" * 22, "internationalization_settings",
                  "see 123e4567-e89b-12d3-a456-426614174000", "someLongCamelCaseIdentifierName/anotherLongIdentifier"):
        assert secrets.find(plain, RANKS) == []


def test_leaks_are_found_in_any_order(spark, docs, empty):
    rng = random.Random(9)
    item = _prose(rng, 30, 10**6).split()
    turned = " ".join(item[18:] + ["x"] + item[:18])
    rows = [(1, "before " + " ".join(item) + " after", "", "", 0, None), (2, turned, "", "", 0, None),
            (3, " ".join(item[:12]), "", "", 0, None), (4, None, "", "", 0, None)]
    bench = spark.createDataFrame([(7, " ".join(item).upper()), (8, None), (9, "tiny"), (10, "")], "item_id long, text string")
    frame = spark.createDataFrame(rows, DOCS)
    got = {(r.doc_id, r.item_id): (r.coverage, r.n_tiles) for r in decontaminate.find_leaks(frame, bench).collect()}
    assert got == {(1, 7): (1.0, 1), (2, 7): (1.0, 2)}
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(frame, bench).collect()) == [3, 4]
    assert decontaminate.find_leaks(empty, bench).count() == 0
    assert decontaminate.find_leaks(frame, bench.limit(0)).count() == 0


def test_tiles_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(40):
        a, b = (rng.integers(1, 4, rng.integers(3, 40)).astype(np.uint64) for _ in range(2))
        got, free_a, free_b, want = decontaminate.tiles(a, b, 3), np.ones(len(a), bool), np.ones(len(b), bool), []
        for size in range(min(len(a), len(b)), 2, -1):
            for p in range(len(a) - size + 1):
                for q in range(len(b) - size + 1):
                    if free_a[p:p + size].all() and free_b[q:q + size].all() and (a[p:p + size] == b[q:q + size]).all():
                        want.append((p, q, size))
                        free_a[p:p + size] = free_b[q:q + size] = False
        assert got == want


def test_quality_counts_equal_brute_force(docs, empty):
    want = {}
    for r in docs.collect():
        text = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = {}
        for i in range(len(w) - 7):
            windows.setdefault(tuple(w[i:i + 8]), []).append(i)
        again = {k for p in windows.values() if len(p) > 1 for i in p for k in range(i, i + 8)}
        want[r.doc_id] = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
                          len(lines) - len(set(lines)), len(again))
    got = quality_rules.quality_verdicts(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want[r.doc_id]
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.quality_verdicts(empty).count() == 0


def test_outliers_go_and_the_rest_stays(spark):
    rng = random.Random(2)
    rows = [(i, _prose(rng, 100), "en", "s", 0, None) for i in range(150)]
    rows += [(1000 + i, " ".join(w + "###" for w in _prose(rng, 100).split()), "en", "s", 0, None) for i in range(10)]
    frame = spark.createDataFrame(rows, DOCS)
    assert sorted(r.doc_id for r in quality_rules.keep_accepted(frame).collect()) == list(range(150))


@pytest.mark.parametrize("junk", [35, 40, 45])
def test_junk_of_over_a_third_goes(spark, junk):
    rng = random.Random(junk)
    rows = [(i, _prose(rng, rng.randrange(60, 200)), "en", "hot", 0, None) for i in range(10 * (100 - junk))]
    rows += [(1000 + i, " ".join(w + "#" * rng.randrange(1, 5) for w in _prose(rng, rng.randrange(60, 200)).split()), "en",
              "hot", 0, None) for i in range(10 * junk)]
    kept = {r.doc_id for r in quality_rules.keep_accepted(spark.createDataFrame(rows, DOCS)).collect()}
    assert kept == set(range(10 * (100 - junk)))


def test_classifier_and_language_on_held_out_rows(spark, empty):
    SF_ORACLE = "/root/testdata/sf0.01"
    frame, labels = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.classify(frame, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in scored) >= 0.9 * len(scored)
    told = language_id.identify(frame).join(frame.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in told) >= 0.98 * len(told)
    odd = spark.createDataFrame([(1, None, None, None, 0, None), (2, "12 34", None, None, 0, None)], DOCS)
    assert [r.lang_pred for r in language_id.predict(odd, language_id.train(frame)).collect()] == ["und", "und"]
    assert language_id.identify(empty).count() == 0
    assert [r.score for r in quality_classifier.classify(odd, labels.limit(0)).collect()] == [0.5, 0.5]


def test_warc_round_trip(spark):
    pages = [(1, "http://a/", "x" * 5), (2, "http://b/\r\nX: y", "x" * 5), (3, None, None), (4, "http://c/", ""),
             (5, "http://d/", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n"), (6, "http://e/", "é" * 9000)]
    got = {r.page_id: r for r in warc.page_archive(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert len(got) == 6
    for i, _, html in pages:
        payload = (html or "").encode()
        same = [j for j, _, h in pages if (h or "") == (html or "")]
        assert (got[i].payload_bytes, got[i].payload_digest) == (
            len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if i == max(same) else ("revisit", max(same)))
    nothing = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.page_archive(nothing).count() == 0


def test_warc_pushes_header_predicates(spark, tmp_path):
    rows = [(f"urn:x:{i}", "response" if i % 2 else "revisit", None, f"http://h/{i}", None, bytearray(b"p" * i)) for i in range(40)]
    schema = "record_id string, record_type string, refers_to string, target_uri string, date string, payload binary"
    warc.write_archives(spark.createDataFrame(rows, schema), str(tmp_path / "w"))
    every = warc.read_archives(spark, str(tmp_path / "w"))
    one = every.where("record_type = 'response' and target_uri >= 'http://h/3'")
    assert sorted(r.target_uri for r in one.collect()) == sorted(
        r[3] for r in rows if r[1] == "response" and r[3] >= "http://h/3")
    assert sorted(len(r.payload) for r in every.where("record_type = 'response'").collect()) == list(range(1, 40, 2))
    headers_only = warc.read_archives(spark, str(tmp_path / "w"), payload=False).where("record_type = 'response'")
    assert {r.payload for r in headers_only.collect()} == {None}


def test_a_second_write_keeps_earlier_archives(spark, tmp_path):
    schema = "record_id string, record_type string, refers_to string, target_uri string, date string, payload binary"
    for k in range(2):
        rows = [(f"urn:x:{k}", "response", None, f"http://h/{k}", None, bytearray(b"p"))]
        warc.write_archives(spark.createDataFrame(rows, schema), str(tmp_path / "w"))
    assert sorted(r.target_uri for r in warc.read_archives(spark, str(tmp_path / "w")).collect()) == ["http://h/0", "http://h/1"]


def test_licenses_and_inheritance(spark, empty):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.py", "print(1)"),
            (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0.\ncode"), (4, "c/z.py", "nothing"),
            (5, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
            (6, None, None), (7, "a/w.py", ""), (8, "top.py", "we care for licensing fees of the harbour")]
    got = {r.file_id: (r.license, r.inherited, r.from_dir)
           for r in licenses.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert got == {1: ("MIT", False, None), 2: ("GPL-3.0", True, "a/b"), 3: ("Apache-2.0", False, None),
                   4: (None, False, None), 5: ("GPL-3.0", False, None), 6: (None, False, None),
                   7: ("MIT", True, "a"), 8: (None, False, None)}
    assert licenses.scan_licenses(licenses.document_files(empty)).count() == 0


def test_wrapped_headers_and_identifiers(spark):
    gnu = ("# This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU {}General "
           "Public License\n# as published by the Free Software Foundation; either\n# version {} of the License, or (at your "
           "option)\n# any later version.\n#\n# It comes without any warranty.\nimport os\n")
    isc = ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
           "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n")
    texts = {"MIT": "// SPDX-License-Identifier: MIT\n", "GPL-2.0": gnu.format("", "2"), "AGPL-3.0": gnu.format("Affero ", "3"),
             "LGPL-2.1": gnu.format("Lesser ", "2.1"), "LGPL-3.0": "x = 1  # SPDX-License-Identifier: LGPL-3.0-or-later",
             "GPL-3.0": gnu.format("", "3"), "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.", "ISC": isc,
             "CC0-1.0": "Licensed under CC0 1.0.", "EPL-2.0": "Eclipse Public License - v 2.0"}
    rows = [(i, f"{i}/x.py", t) for i, t in enumerate(texts.values())]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()
    assert {r.file_id: r.license for r in got} == dict(enumerate(texts))


def test_word_hashes_do_not_depend_on_place():
    def hashes(text):
        buf = np.frombuffer(text, np.uint8)
        return textops.words(buf, np.array([0, len(buf)]), True)[0]
    assert hashes(b"One two")[0] == hashes(b"  zero one")[1]
    assert len(set(hashes(b"ab ba abc a b").tolist())) == 5


def test_pipeline_stages(spark):
    import corpus_pipeline
    SF_SMOKE = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMOKE).collect()
    judged = {r.doc_id for r in quality_rules.quality_verdicts(docs).where("kept").collect()}
    left = docs.where(docs.doc_id.isin(list(judged)))
    near = {r.doc_id for r in near_dedup.near_duplicates(left).where("kept").collect()}
    left = left.where(left.doc_id.isin(list(near)))
    leaks = {r.doc_id for r in decontaminate.find_leaks(left, spark.read.parquet(f"{SF_SMOKE}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in out} == near - leaks
    texts = {r.doc_id: r.text for r in left.collect()}
    tool = Tokenizer.from_file(VOCABULARY)
    for r in out:
        text = secrets._masked(texts[r.doc_id], secrets.find(texts[r.doc_id], RANKS))
        assert list(r.ids) == tool.encode(text, add_special_tokens=False).ids


def test_checksum_clash_and_repeated_rows_of_one_id(spark):
    import time
    import zlib
    seen, rng, clash = {}, random.Random(0), None
    while clash is None:  # two texts of one crc32
        text = "%016x" % rng.getrandbits(64)
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        clash = (text, other) if other != text else None
    passage = "x" + _prose(random.Random(2), 150)
    a, b = (head + passage[1:] for head in ("a", "b"))
    a, b = a + clash[0], b + clash[0]
    rows = [(None, a, None, None, None, None), (None, b, None, None, None, None)]
    rows += [(None, clash[0] * 30, None, None, None, None), (None, clash[1] * 30, None, None, None, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == 4 and sorted(r.n_removed for r in got)[2:] == [len(a) - 1] * 2
    for n in (100, 400):
        same = spark.createDataFrame([(None, passage, None, None, None, None)] * n, DOCS)
        tables = suffix_dedup.Tables(spark, "test")
        spans = suffix_dedup.repeated_spans(tables, suffix_dedup._keyed(same), 400).collect()
        assert len(spans) == 1 and len(spans[0].spans) < 40  # whatever the number of equal rows
    start = time.time()
    same = spark.createDataFrame([(None, passage, None, None, None, None)] * 10_000, DOCS).repartition(8)
    got = suffix_dedup.remove_repeats(same).groupBy("n_removed", "n_spans").count().collect()
    assert [tuple(r) for r in got] == [(len(passage), 1, 10_000)] and time.time() - start < 120


def test_dense_family_of_one_component_is_not_dealt(spark, monkeypatch):
    rng = random.Random(4)
    words = _prose(rng, 200).split()
    texts = []
    for k in range(300):
        changed = list(words)
        changed[k % 200] = f"edit{k}"
        texts.append(" ".join(changed))
    rows = [(i, t, None, None, None, None) for i, t in enumerate(texts)]
    kept = {}
    put = near_dedup.Tables.put

    def counted(self, df, name):
        out = put(self, df, name)
        if name in ("mixed", "rest"):
            kept[name] = out.count()
        return out
    monkeypatch.setattr(near_dedup.Tables, "put", counted)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), shingle=3, percent=85).collect()
    assert {r.component_id for r in got} == {0} and kept["mixed"] == 0


def test_stages_keep_columns_with_clashing_names(spark):
    text = _prose(random.Random(1), 60)
    rows = [(i, text + f" {i}", "en", "s", 1, "mine", "mine", "mine", "mine", 7) for i in range(70)]
    docs = spark.createDataFrame(rows, DOCS + ", _id string, _key string, spans string, n_hex long")
    docs = docs.withColumn("id", docs["_id"]).withColumn("key", docs["_key"])
    kept = quality_rules.keep_accepted(docs)
    assert kept.columns == docs.columns
    assert {tuple(r[5:]) for r in kept.collect()} == {("mine", "mine", "mine", "mine", 7, "mine", "mine")}
    masked = secrets.mask_secrets(docs, RANKS)
    assert masked.columns == docs.columns
    assert {tuple(r[5:]) for r in masked.collect()} == {("mine", "mine", "mine", "mine", 7, "mine", "mine")}


@pytest.mark.parametrize("bound", [common.BROADCAST_BYTES, 0])
def test_stages_that_drop_rows_shuffle_no_whole_table(spark, monkeypatch, bound):
    rng = random.Random(6)
    rows = [(i, _prose(rng, 100), "en", "s", 0, None) for i in range(150)]
    rows += [(1000 + i, " ".join(w + "###" for w in _prose(rng, 100).split()), "en", "s", 0, None) for i in range(10)]
    rows += [(200 + i, rows[i][1], "en", "s", 0, None) for i in range(5)] + [rows[9]]  # copies, and a row that comes twice
    path = common.Tables(spark, "test-docs").path("documents")
    spark.createDataFrame(rows, DOCS).write.parquet(path)
    docs = spark.read.parquet(path)
    monkeypatch.setattr(common, "BROADCAST_BYTES", bound)
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k in limits:
            spark.conf.set(k, "-1")  # as if the keys were more than the planner broadcasts by itself
        for stage, want in ((quality_rules.keep_accepted, [*range(150), *range(200, 205), 9]),
                            (near_dedup.keep_one_of_each_group, [*range(150), *range(1000, 1010)])):
            out = stage(docs)
            assert sorted(r.doc_id for r in out.collect()) == sorted(want)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan) == (bound > 0)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
