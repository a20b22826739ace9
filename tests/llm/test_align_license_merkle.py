"""Token alignment, license scans and Merkle manifests against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("trueform.llm")

from pyspark.sql import functions as F  # noqa: E402

from trueform.llm import alignment, licenses, merkle, queries  # noqa: E402
from trueform.llm.common import on_path  # noqa: E402
from trueform.llm.license_rules import BASE, KINDS, rules  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, block string, g string, digest string, size int, path string"
A, B = (queries.vocabulary_file(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def spark(spark):
    on_path(spark)
    return spark


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B, entries=400)


def frame(spark, rows):
    """(doc_id, text, source) rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None if i is None else "en", s, None if t is None else len(t), "x", "y", "z", 1, "p") for i, t, s in rows], DOCS)


def odd_texts():
    rng = random.Random(7)
    parts = ["a", " ", "\n", "é", "the", "X1", ".", ",", "\t", "　", "'s", "🙂", "​", "'", "日本", "▁", "</s>", "<|endoftext|>", "<0x0A>", "the end", " of"]
    texts = [None, "", " ", "\n", "a", "a ", "\n\nx  y\n z", "ﬁ \x00y", "\r\nfoo \n bar", "x" * 700, "é" * 300 + " " + "́" * 5, "don't we'll", "a\x85b c d⁠e"]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(400)]


def plain_alignment(own, text):
    """Whole text through both tokenizers, tokens compared pair by pair."""
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = own.a.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)
    if b"".join(own.a_bytes[i] for i in a) != whole or b"".join(own.b_bytes[i] for i in b) != whole:
        return None
    spans = []
    for ids, table in ((a, own.a_bytes), (b, own.b_bytes)):
        ends = np.cumsum([len(table[i]) for i in ids]).tolist()
        spans.append([(i, s, e) for i, s, e in zip(ids, [0, *ends], ends)])
    links = [(x, y) for x, xs, xe in spans[0] for y, ys, ye in spans[1] if max(xs, ys) < min(xe, ye)]
    ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
    groups = [[[i for i, s, e in side if lo < e <= hi] for side in spans] for lo, hi in zip([0, *ends], ends)]
    text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
    return len(a), len(b), len(ends), len(links), sum(len(x) * len(y) for x, y in groups), text, Counter(links)


def test_sparse_products():
    rng = np.random.default_rng(5)
    for _ in range(20):
        left, right = rng.random((rng.integers(1, 9), 7)) < 0.4, rng.random((7, rng.integers(1, 9))) < 0.4
        csr = [alignment.Csr(np.concatenate([[0], np.cumsum(m.sum(1))]), np.nonzero(m)[1], m.shape[1]) for m in (left, right)]
        out = np.zeros((left.shape[0], right.shape[1]), dtype=int)
        for rows, cols, values in alignment.product(*csr, limit=5):
            out[rows, cols] += values
        assert (out == left.astype(int) @ right.astype(int)).all()
        back = csr[0].transpose()
        assert all((back.idx[back.ptr[j]:back.ptr[j + 1]] == np.flatnonzero(left[:, j])).all() for j in range(7))


def test_alignment_of_texts(aligner):
    texts = odd_texts()
    for at in range(0, len(texts), 90):  # more units than are remembered
        part = texts[at:at + 90]
        counts, groups, offsets, pairs, times = aligner.align(part)
        for i, text in enumerate(part):
            want = plain_alignment(aligner, text)
            got = {(p >> 32, p & 0xFFFFFFFF): t for p, t in zip(pairs[offsets[i]:offsets[i + 1]].tolist(), times[offsets[i]:offsets[i + 1]].tolist())}
            if want is None:
                assert counts[i].tolist() == [0] * 5 and groups[i] == "" and not got, text
            else:
                assert (*counts[i].tolist(), groups[i], got) == want, text
    assert len(aligner.known) <= 400


def test_group_product_gives_its_count():
    a, b = np.array([1, 2, 1, 3, 2]), np.array([3, 1, 1, 4])
    ga, gb, ends = alignment.group_of(np.cumsum(a), np.cumsum(b))
    links = [np.concatenate(x) for x in zip(*alignment.shared_group_links(ga, gb, len(ends)))]
    assert set(zip(links[0].tolist(), links[1].tolist())) == {(i, j) for i, x in enumerate(ga) for j, y in enumerate(gb) if x == y}
    sizes = alignment.product_sizes(alignment.membership(ga, len(ends)), alignment.membership(gb, len(ends)).transpose())
    assert sizes.sum() == len(links[0])


def check_alignment(spark, rows, own):
    got = alignment.token_alignment(frame(spark, [(i, t, "s") for i, t in rows]).repartition(3), A, B).collect()
    plain = [plain_alignment(own, t) for _, t in rows]
    docs = Counter(p for w in plain if w for p in w[6])
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    want = []
    for (i, _), w in zip(rows, plain):
        if w is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            want.append((i, *w[:4], sum(t for p, t in w[6].items() if docs[p] == best[p[0]]), sum(t * docs[p] for p, t in w[6].items()),
                         hashlib.sha256(w[5].encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got), key=key) == sorted(want, key=key)


def test_token_alignment(spark, aligner, monkeypatch):
    rows = [(i, t) for i, t in enumerate(odd_texts()[:150])] + [(3, "the end"), (3, "the end"), (None, "of the end")]
    check_alignment(spark, rows, aligner)


def test_token_alignment_cold_pairs(spark, aligner, monkeypatch):
    """Hot and cold id pairs are fetched in two ways with one result."""
    monkeypatch.setattr(alignment, "HOT_SHARE", 3)
    check_alignment(spark, [(i, "the end of the tale " + str(i % 4)) for i in range(40)] + [(99, None)], aligner)


def test_alignment_long_and_empty(spark, aligner):
    long = "on and on the tale goes, line by line.\n" * 80_000  # over a slice
    got = alignment.token_alignment(frame(spark, [(1, long, "s"), (2, "short", "s")]), A, B).orderBy("doc_id").collect()
    one = plain_alignment(aligner, "on and on the tale goes, line by line.\n" * 2)
    half = plain_alignment(aligner, "on and on the tale goes, line by line.\n")
    assert got[0].n_links == half[3] + (one[3] - half[3]) * 79_999 and got[1].n_a > 0
    assert alignment.token_alignment(frame(spark, []), A, B).count() == 0
    assert alignment.token_alignment(frame(spark, [(1, None, "s")]), A, B).first().groups_sha256 == ""


# license scans

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_scan(text):
    """Every rule on every text; suppression pair by pair."""
    words = WORD.findall(lowered(text))
    line = " " + " ".join(words) + " "
    found = []
    for n, r in enumerate(rules()):
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", line):
            first = line[:m.start()].count(" ") - 1
            found.append((r.priority, -len(m.group().split(" ")), first, n, r))
    found.sort(key=lambda x: x[:4])
    kept = []
    for x in found:
        if x[4].base or not any(y[2] <= x[2] and x[2] - x[1] <= y[2] - y[1] for y in kept):
            kept.append(x)
    return len(words), sorted((x[2], x[2] - x[1], x[4].name) for x in kept), len(found) - len(kept)


def license_texts():
    rng = random.Random(3)
    bits = ["GNU General Public License", "gnu  general,public\nlicense", "version 2.0", "v3", "or later", "Apache License, Version 2.0", "MIT License", "CC BY", "CC BY 4.0",
            "CC-BY-SA 3.0", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: MIT", "licensed under the terms of the", "Mozilla Public License 2.0",
            "http://www.apache.org/licenses/LICENSE-2.0", "the", "word", "éa", "license", "cc by cc by", "BSD 3-Clause License", "Lesser General Public License v2.1",
            "You should have received a copy of the GNU General Public License", "Creative Commons Attribution-ShareAlike 4.0 International", "All rights reserved.", "LGPLv3+"]
    texts = [None, "", " ", "mit license", "MIT licenses", "xmit license", "gnu general public licenseé", "MIT\x00License", "İ mit license", "mit license" * 3]
    return texts + [rng.choice([" ", "\n", ". "]).join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for _ in range(250)]


def test_rules_hold_their_keywords():
    listed = rules()
    assert len(listed) > 300 and len({r.name for r in listed}) == len(listed)
    assert {r.label for r in listed if r.base} == set(BASE.values()) and all(r.keywords for r in listed)
    # a rule's plain words are a text that it matches: its keywords must stand in it
    for r in listed:
        if r.kind == "name" and "(" not in r.pattern:
            assert all(k in r.pattern for k in r.keywords), r.name


def test_license_scan_against_all_rules(spark):
    texts = license_texts()
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "mit license", "s"), (3, "mit license", "s")]
    got = licenses.scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, text, _ in rows:
        n, kept, suppressed = plain_scan(text)
        for r in by_id[i]:
            assert (r.n_words, sorted((d.first_word, d.end_word, d.rule) for d in r.detections), r.n_suppressed) == (n, kept, suppressed), text
            raw = (text or "").encode()
            for d in r.detections:
                assert len(WORD.findall(lowered(raw[d.start_byte:d.end_byte].decode()))) == d.end_word - d.first_word
    assert any(r.n_suppressed for r in got) and {d.kind for r in got for d in r.detections} == set(KINDS)


def test_license_query_base_places(spark, tmp_path):
    texts = license_texts()
    frame(spark, [(i, t, "s") for i, t in enumerate(texts)]).write.parquet(str(tmp_path / "documents.parquet"))
    for r in queries.op12_license_scans(spark, str(tmp_path)).collect():
        words = WORD.findall(lowered(texts[r.doc_id]))
        places = [(p, label) for phrase, label in BASE.items() for p in range(len(words)) if words[p:p + len(phrase.split())] == phrase.split()]
        assert r.n_words == len(words) and r.n_base == len(places)
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_license_scan_long_and_empty(spark):
    long = "word " * 700_000 + "Apache License " + "x" * 100
    row = licenses.scan(frame(spark, [(1, long, "s")])).first()
    assert row.n_words == 700_003 and [d.first_word for d in row.detections if d.kind == "base"] == [700_000]
    assert licenses.scan(frame(spark, [])).count() == 0


# Merkle manifests

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    """Root, and for each leaf its siblings as (left, right) level by level."""
    paths, place, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for k, p in enumerate(place):
            lo = p // 16 * 16
            paths[k].append(("".join(nodes[lo:p]), "".join(nodes[p + 1:lo + 16])))
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        place = [p // 16 for p in place]
    return nodes[0], paths


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_manifest(rows):
    rows = [(i, s, "en" if i is not None else None, None if t is None else len(t), t) for i, t, s in rows]
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, h(*map(enc, r)), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, tops = plain_tree([trees[s][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for x, path in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1]):
            i, text = x[3][0], x[3][4]
            low = lowered(text) if text is not None and i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else text
            now = h(*map(enc, (*x[3][:4], low)))
            for left, right in path + tops[n]:
                now = h(left, now, right)
            out.append((i, x[2], trees[s][0], root, h(*[a + b for a, b in path + tops[n]]), now, now == root))
    return out


def merkle_rows(seed):
    rng = random.Random(seed)
    rows = [(i, f"Text {rng.random()} É", "hot") for i in rng.sample(range(-500, 5000), 600)]
    rows += [(i, "Few words", f"s{i % 23:02d}") for i in range(6000, 6100)]
    rows += [(7000, None, None), (7001, "", None), (None, "no id", "s01"), (None, None, "s02"), (7002, "alone", ""), (7003, "ALONE", "é"), (6000, "Few words", "s20"), (6000, "Other", "s20")]
    return rows + [(8000 + i, "x" * i, f"one-{i}") for i in range(20)]


def test_manifest_against_plain_tree(spark, tmp_path):
    for rows in (merkle_rows(1), [(5, "One Text", "s")], [(0, "A", "s"), (0, "A", "s"), (0, "A", "s")], [(i, "T", None) for i in range(17)]):
        path = str(tmp_path / f"{len(rows)}")
        frame(spark, rows).repartition(5).write.parquet(f"{path}/documents.parquet")
        got = [tuple(r) for r in queries.op13_merkle_manifest(spark, path).select(
            "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
        assert Counter(got) == Counter(plain_manifest(rows))
    assert any(not r[-1] for r in plain_manifest(merkle_rows(1)))


def test_manifest_empty_and_clash(spark):
    cols = ["doc_id", "source", "text"]
    assert merkle.manifest(frame(spark, []), "source", "doc_id", cols).count() == 0
    with pytest.raises(ValueError):
        merkle.manifest(frame(spark, []), "source", "doc_id", cols, {"path": F.lit(1)})


def test_manifest_deals_a_hot_group(spark, monkeypatch):
    """Ranks of one group come from several ranges."""
    seen = {}
    real = merkle.saved

    def spy(df, name):
        out = real(df, name)
        if name == "ranges" and name not in seen:
            seen[name] = out.select("part").distinct().count()
        return out
    rows = [(i, f"t{i}", "hot") for i in range(3000)]
    monkeypatch.setattr(merkle, "saved", spy)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges stay apart
    try:
        deal(spark, rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert seen["ranges"] > 1


def deal(spark, rows):
    assert merkle.manifest(frame(spark, rows).repartition(4), "source", "doc_id", ["doc_id"]).select("root").distinct().count() == 1
