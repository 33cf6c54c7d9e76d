"""Operators whose result has a short exact definition, against that definition, on odd and random texts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from tabwright.llm.decontaminate import decontaminate, find_contamination
from tabwright.llm.licenses import ANCHORS, SENTENCES, scan_licenses
from tabwright.llm.line_dedup import dedup_lines
from tabwright.llm.packing import pack_documents
from tabwright.llm.pii import emails, find_personal_data, luhn, masked, mod97, propose
from tabwright.llm.rans import Table, decode_blocks, encode_blocks, read_token_files, write_token_files
from tabwright.llm.simhash import anchor_rows, forest, near_duplicates
from tabwright.llm.suffix_dedup import LoserTree, anchors, dedup_substrings, front_coded, unfronted
from tests.oracle_check import compare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "Żółć naïve ÇA İstanbul ×2 é don't <|endoftext|> x y"), (None, "A null id."), (5, "Same text."),
       (5, "Same text."), (6, "word " * 3000), (7, "\x1c odd \x0b marks \x85 here\r\n"), (8, "# | <b> 12,345.67 ½ 你好 ١٢")]


def test_license_sql(spark, small_folder, small_db):
    key = "op3_licenses"
    assert compare(corpus_pipeline.QUERIES[key](spark, small_folder), small_db, corpus_pipeline.SQL[key]) is None


def test_license_readings(corpus):
    assert all(any(a in s for a in ANCHORS) for s in SENTENCES)
    wrapped = "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated\ndocumentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to\nwhom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, "Licensed under CC BY-NC 4.0.\nAll rights reserved."), (2, wrapped), (3, None), (4, "Nothing here."),
            (5, "SPDX-License-Identifier: Apache-2.0"), (6, "This program is free software.")]
    got = {r.doc_id: (r.licences, r.n_licences, r.left_over) for r in scan_licenses(corpus(rows)).collect()}
    assert got == {1: ("CC-BY-NC-4.0,Proprietary", 2, False), 2: ("MIT", 1, True), 3: ("", 0, False), 4: ("", 0, False),
                   5: ("Apache-2.0", 1, False), 6: ("", 0, False)}


def test_packing_covers_every_id_once(corpus):
    rng = random.Random(3)
    rows = ODD + [(100 + k, " ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(rng.choice([3, 700, 2047, 2048, 5000])))) for k in range(40)]
    pieces = pack_documents(corpus(rows), TOKENIZER).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    want = collections.Counter((i, zlib.crc32(np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for i, t in rows)
    by_doc, lengths, places = collections.defaultdict(list), collections.Counter(), collections.defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        by_doc[p.doc_id, p.doc_tokens].append(p)
        lengths[p.sequence_id] += p.length
        places[p.sequence_id].append((p.offset, p.length))
    for (doc, total), own in by_doc.items():
        if doc != 5:
            own.sort(key=lambda p: p.start)
            assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1].tolist()]
            assert want[doc, zlib.crc32(b"".join(bytes(p.ids) for p in own))] == 1
    assert sum(p.length for p in pieces if p.doc_id == 5) == 2 * by_doc[5, by_doc_tokens(by_doc, 5)][0].doc_tokens
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values()) and max(lengths.values()) == 2048


def by_doc_tokens(by_doc, doc):
    return next(total for d, total in by_doc if d == doc)


def test_token_files_round_trip(spark, corpus):
    rows = ODD + [(50 + k, f"text number {k} " * (k * 37 % 400)) for k in range(60)]
    got = read_token_files(spark, write_token_files(corpus(rows), TOKENIZER, ids_per_file=5_000)).collect()
    whole = Tokenizer.from_file(TOKENIZER)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for (doc, text), row in zip(order, sorted(got, key=lambda r: r.start)):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [2]
        assert (row.doc_id, row.start, row.n_tokens, bytes(row.ids)) == (doc, start, len(ids), np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(rows)
    assert read_token_files(spark, write_token_files(corpus([]), TOKENIZER)).count() == 0


@pytest.mark.parametrize("n", [1, 31, 32, 16_385, 65_536, 70_001])
def test_blocks_decode_and_damage_shows(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 40_000).astype(np.uint32)
    table = Table.load(Table.of_counts(np.bincount(ids.astype(int))).dump())
    blocks = encode_blocks(ids, table)
    assert (np.concatenate(decode_blocks(blocks, table)) == ids).all()
    if n > 100:
        bad = bytearray(blocks[0])
        bad[len(bad) * 3 // 4] ^= 1
        with pytest.raises(ValueError):
            decode_blocks([bytes(bad)], table)


def test_personal_data(corpus):
    pattern = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("ab.@_ -%") for _ in range(30))
        assert list(emails(text)) == [m.span() for m in pattern.finditer(text)]
    assert luhn("4111111111111111") and not luhn("4111111111111112") and mod97("GB82WEST12345698765432")
    text = "mail bob@x.org or +1 (555) 010-9999, card 4111 1111 1111 1111; host 10.0.0.300 10.0.0.30 iban GB82 WEST 1234 5698 7654 32"
    rows = {r.doc_id: r.spans for r in find_personal_data(corpus(ODD + [(90, text), (91, "1" * 5000), (92, "a" * 100_000)])).collect()}
    kinds = [s.kind for s in rows[90]]
    assert kinds == ["email", "phone", "card", "ip", "iban"] and rows[91] == [] and rows[92] == []
    assert next(s for s in rows[90] if s.kind == "card").checksum == "luhn" and rows[90][0].score == 1.0
    assert masked(corpus([(1, text), (2, None)])).where("doc_id = 1").first().text.startswith("mail [email] or [phone], card [card];")


def test_iban_with_words_behind_it():
    first, second = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"
    for text, want in ((f"IBAN {first} BIC COBADEFFXXX", [first]), (f"{first} 2024", [first]), (f"to {second} A new", [second]),
                       (f"{first} {second} OR {first}", [first, second, first]), (f"{first[:-1]}1 BIC", []), (f"AB12 3456 7890 123 {first}", [first])):
        assert [text[s:e] for kind, s, e, _ in propose(text) if kind == "iban"] == want


def test_contamination_against_windows(spark, corpus):
    rng = random.Random(5)
    words = "a b c Dé e f7 g".split()

    def text(n):
        return " ".join(rng.choice(words) + rng.choice(["", ",", "!"]) for _ in range(n))

    items = [(k, text(rng.choice([0, 3, 9, 10, 15, 30]))) for k in range(20)] + [(99, None), (3, text(12))]
    docs = ODD + [(200 + k, " ".join([text(rng.randrange(40)), rng.choice(items[:20])[1], text(rng.randrange(9))])) for k in range(60)]
    table = spark.createDataFrame(items, "item_id long, text string")

    def split(t):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))

    windows = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(str(i))
    want = collections.Counter()
    for i, t in docs:
        w, hit, names = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    names |= found
        want[i, len(w), len(hit), tuple(sorted(names))] += 1
    for block_words in (400_000, 20):
        got = find_contamination(corpus(docs), table, block_words=block_words).collect()
        assert collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    text = "Intro words stay. " + "one two three four five six seven eight nine ten" + " and the end."
    one = spark.createDataFrame([("i", "One two three four five six seven eight nine TEN")], "item_id string, text string")
    out = decontaminate(corpus([(1, text), (2, text[18:66]), (3, None)]), one, most_share=0.8).orderBy("doc_id").collect()
    assert [(r.doc_id, r.text) for r in out] == [(1, "Intro words stay.  and the end."), (3, None)]


def bits(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components(corpus):
    rng = random.Random(2)
    base = ["w%d" % rng.randrange(50) for _ in range(400)]
    docs = [r for r in ODD if r[0] is not None]
    for k in range(150):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(400)] = "x"
        docs.append((300 + k, " ".join(words)))
    got = near_duplicates(corpus(docs)).collect()
    prints = [bits(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root(a) != root(b):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        least[root(k)] = min(i, least.get(root(k), i))
    want = collections.Counter((i, f"{p:016x}", least[root(k)]) for k, ((i, _), p) in enumerate(zip(docs, prints)))
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert near_duplicates(corpus([])).count() == 0


def test_linked_fingerprints_share_an_anchor():
    rng = np.random.default_rng(4)
    own = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    for flips in (1, 2, 3):
        other = own.copy()
        for _ in range(flips):
            other ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
        a, rows_a = anchor_rows(own)
        b, rows_b = anchor_rows(other)
        met = {(x, r) for x, r in zip(a.tolist(), rows_a.tolist())} & {(x, r) for x, r in zip(b.tolist(), rows_b.tolist())}
        assert {r for _, r in met} == set(range(500))


def test_large_anchor_is_dealt_in_chunks(spark):
    from tabwright.llm.components import components
    from tabwright.llm.simhash import links

    fps = [(1 << k) | (1 << j) for k in range(16) for j in range(k)] + [0]
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    assert {r.root for r in components(links(frame, chunk=8)).collect()} == {0}
    assert len(forest(np.zeros(len(fps), np.int64), np.array(fps, np.uint64), 3)[0]) == len(fps) - 1


def substring_rows(docs):
    seen = collections.Counter(x[k:k + 200] for _, x in docs for k in range(len(x) - 199))
    rows = []
    for i, x in docs:
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - 199):
            if seen[x[k:k + 200]] > 1:
                gone[k:k + 200] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(x) else 0))
        rows.append((i, len(x), int(gone.sum()), runs, bytes(b for b, g in zip(x, gone) if not g)))
    return collections.Counter(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_substrings(corpus, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abé \n") for _ in range(1500)) for _ in range(3)]
    docs = list(ODD)
    for i in range(60):
        text = ""
        while rng.random() < 0.8:
            start = rng.randrange(1200)
            text += rng.choice(base)[start:start + rng.choice([50, 150, 199, 200, 201, 260, 400])]
            if rng.random() < 0.3:
                text += "".join(rng.choice("ab \n") for _ in range(rng.choice([1, 5, 100])))
            if rng.random() < 0.1:
                text += rng.choice(["a", "ab", "abc "]) * rng.choice([100, 210])
        docs.append((100 + i, text))
    docs += docs[-3:-1]
    got = dedup_substrings(corpus(docs, 5)).collect()
    assert substring_rows([(i, (t or "").encode()) for i, t in docs]) == collections.Counter(
        (r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in got)


def test_loser_tree_and_front_coding():
    rng = random.Random(8)
    for count in (1, 2, 3, 7, 8):
        runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))) for _ in range(rng.randrange(40))) for _ in range(count)]
        coded = [front_coded(r) for r in runs]
        assert [unfronted(*c) for c in coded] == runs
        out = [(runs[r][k], same) for r, k, same in LoserTree([(r, c[0]) for r, c in zip(runs, coded)])]
        assert [x for x, _ in out] == sorted(x for r in runs for x in r)
        last = b""
        for x, same in out:
            n = 0
            while n < min(len(x), len(last)) and x[n] == last[n]:
                n += 1
            assert same == n
            last = x


def test_every_string_has_an_anchor_that_depends_on_it_alone():
    data = np.frombuffer(random.Random(1).randbytes(3000) + b"ab" * 300, np.uint8)
    place, _ = anchors(data, np.array([0, len(data)]))
    for start in range(0, len(data) - 200, 7):
        own, _ = anchors(data[start:start + 200], np.array([0, 200]))
        assert len(own) == 1 and start + own[0] in place


def line_rows(docs, least):
    docs = sorted(docs)
    runs = collections.defaultdict(list)
    lines = [[x for line in t.split("\n") if (x := line.strip(" \t\n\v\f\r"))] for _, t in docs]
    for d, own in enumerate(lines):
        for p in range(len(own)):
            total, q = 0, p
            while q < len(own) and total < least:
                total, q = total + len(own[q].split()), q + 1
            if total >= least:
                runs[tuple(own[p:q])].append((d, p, q))
    gone = [set() for _ in docs]
    for places in runs.values():
        first = min(places)
        for d, p, q in places:
            if (d, p, q) != first:
                gone[d] |= set(range(max(p, first[2]) if d == first[0] else p, q))
    return {i: (len(lines[d]), len(gone[d])) for d, (i, _) in enumerate(docs)}


def test_line_runs(corpus):
    rng = random.Random(6)
    stock = [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.choice([1, 2, 5, 9]))) for _ in range(25)]
    docs = [(i, "\n".join(rng.choice(["", " "]) + x for k in range(rng.randrange(1, 9)) for x in (lambda s: stock[s:s + rng.randrange(1, 6)])(rng.randrange(20))))
            for i in range(80)] + [(80, "x x x\n" * 40)]
    got = dedup_lines(corpus(docs), least_words=12).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in got} == line_rows(docs, 12)
    odd = dedup_lines(corpus(ODD), least_words=2).collect()
    assert len(odd) == len(ODD) and {r.text for r in odd if r.doc_id == 1} == {None} and dedup_lines(corpus([])).count() == 0
    assert [r.text for r in odd if r.doc_id == 5] == ["Same text.", "Same text."]


def test_digest_columns(spark, small_folder):
    """The queries derive their digests from the operators' real output."""
    for key in ("op2_contamination", "op4_suffix_dedup", "op6_personal_data", "op7_token_files"):
        frame = corpus_pipeline.QUERIES[key](spark, small_folder)
        assert frame.count() == 200
        for name in [c for c in frame.columns if c.endswith("sha256")]:
            assert frame.where(f"length({name}) <> 64").count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    found = corpus_pipeline.QUERIES["op6_personal_data"](spark, small_folder)
    assert found.where(f"spans = '' AND base_sha256 <> '{empty}'").count() == 0
