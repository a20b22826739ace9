"""Training-data operators against brute force, exact round trips and held-out accuracy on small frames."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("trueform.llm")

from pyspark.sql import functions as F  # noqa: E402

from trueform.llm import chat, decontaminate, embed_dedup, langid, minhash, packing, quality, substring, suffix_dedup, token_counts  # noqa: E402
from trueform.llm.common import on_path  # noqa: E402
from trueform.llm.components import connected_components  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_key string, g string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau ypsilon".split()


@pytest.fixture(scope="module")
def spark(spark):
    on_path(spark)
    return spark


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "n"]) for _ in range(n))


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en" if i is None or i % 2 else "de", "s0", 0, "x", "y") for i, t in rows], DOCS)


def corpus(seed=1):
    rng = random.Random(seed)
    shared, base = prose(rng, 60), prose(rng, 80)
    rows = [(i, prose(rng, rng.randint(1, 60))) for i in range(30)]
    rows += [(100 + i, base) for i in range(5)]
    for i in range(12):
        words = base.split()
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = "edit" + str(rng.randint(0, 99))
        rows.append((200 + i, " ".join(words)))
    rows += [(300 + i, prose(rng, 10) + ".\n" + shared + "\n" + prose(rng, 12)) for i in range(6)]
    rows += [(400, None), (401, ""), (402, " \n "), (403, "ab" * 400), (404, "é" * 120 + "z" + "é" * 130), (405, "one two"), (406, "one two"), (407, "x" * 99), (408, "x" * 100)]
    rows += [(None, base), (100, base), (409, prose(rng, 3000))]
    return rows


def first_texts(rows):
    return {i: t or "" for i, t in rows if i is not None}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(30)] + [(5, 5), (None, 3)]
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    least = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in range(300):
        for a, b in edges:
            if a in least and b in least:
                least[a] = least[b] = min(least[a], least[b])
    assert got == least
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = corpus() + [(500, "It's  a <|endoftext|> Test\tİstanbul ÀÉ, x. y.. ... <|startoftext|>"), (501, "ǅ ﬁ é ß\u0085tab")]
    got = packing.pack(packing.token_pieces(frame(spark, rows), P.path("word_bpe_49k.json"), 64).cache(), 64, 16).collect()
    by_row = defaultdict(list)
    for r in got:
        by_row[r.row_key].append(r)
    made = []
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
        made.append((pieces[0].doc_id is None, pieces[0].doc_id or 0, tuple((r.length, r.ids_crc32, r.doc_tokens) for r in pieces)))
    want = []
    for i, t in rows:
        ids = np.array(model.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i is None, i or 0, tuple((len(ids[a:a + 64]), zlib.crc32(ids[a:a + 64].tobytes()), len(ids)) for a in range(0, len(ids), 64))))
    assert sorted(made) == sorted(want)
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        spans.sort()
        assert [o for o, _ in spans] == list(np.cumsum([0] + [n for _, n in spans[:-1]])) and sum(n for _, n in spans) <= 64
    assert packing.pack(packing.token_pieces(frame(spark, []), P.path("word_bpe_49k.json"))).count() == 0


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 50) for _ in range(300)), reverse=True)
    where, _ = packing.best_fit(np.array(lengths), 50)
    left = []
    for need, w in zip(lengths, where.tolist()):
        fits = [x for x in left if x >= need]
        if fits:
            assert left[w] == min(fits)
        else:
            assert w == len(left)
            left.append(50)
        left[w] -= need


def test_sequences_pad_unless_a_power_of_two(spark):
    rows = [(0, 0, [5] * 8), (1, 0, [5] * 3), (1, 3, [6] * 2)]
    packed = spark.createDataFrame(rows, "sequence_id long, offset long, ids array<long>")
    got = {r.sequence_id: r.ids for r in packing.sequences(packed, 16).collect()}
    assert got[0] == [5] * 8 and got[1] == [5] * 3 + [6] * 2 + [0] * 11


def test_packed_documents_hold_their_token_ids(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = corpus()
    made = packing.pack_documents(frame(spark, rows), P.path("word_bpe_49k.json"), 64, pad_id=7, shard_pieces=16)
    sequences = made.collect()
    found = []
    for s in sequences:
        ids = np.frombuffer(s.ids, "<u4").tolist()
        assert s.n_tokens == sum(p.length for p in s.pieces) <= 64
        assert len(ids) == (s.n_tokens if s.n_tokens & (s.n_tokens - 1) == 0 else 64) and set(ids[s.n_tokens:]) <= {7}
        assert [p.offset for p in s.pieces] == [sum(q.length for q in s.pieces[:k]) for k in range(len(s.pieces))]
        found += [(p.doc_id or 0, p.start, p.doc_tokens, tuple(ids[p.offset:p.offset + p.length])) for p in s.pieces]
    assert any(len(s.ids) > 4 * s.n_tokens for s in sequences) and len({s.sequence_id for s in sequences}) == len(sequences)
    want = []
    for i, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids + [2]
        want += [(i or 0, a, len(ids), tuple(ids[a:a + 64])) for a in range(0, len(ids), 64)]
    assert sorted(found) == sorted(want)
    pieces = packing.placed_pieces(made, with_sequence=True).collect()
    assert sorted((r.doc_id or 0, r.start, r.doc_tokens, r.ids_crc32) for r in pieces) == sorted((i, a, n, zlib.crc32(np.array(x, "<u4").tobytes())) for i, a, n, x in want)
    assert {r.sequence_id: r.sequence for r in pieces if r.offset == 0} == {s.sequence_id: s.ids for s in sequences}
    assert all((r.sequence is None) == (r.offset > 0) for r in pieces)
    none = packing.pack_documents(frame(spark, []), P.path("word_bpe_49k.json"))
    assert none.count() == 0 and packing.placed_pieces(none).count() == 0


@pytest.mark.parametrize("short", [False, True])
def test_decontamination(spark, short):
    rows = corpus()
    texts = [t for _, t in rows if t and len(t.split()) > 40]
    items = [(1, " ".join(texts[0].split()[3:30])), (2, texts[-1].upper()[:200]), (3, "nothing here at all of the kind that could be found anywhere in it"), (4, None), (5, "..."), (2, texts[-1].upper()[:200])]
    items += [(6, "one two"), (7, "Alpha"), (8, " ".join(texts[1].split()[:9]))] if short else []
    got = decontaminate.contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    want = []
    for i, t in rows:
        w, hit, ids = cut(t), set(), set()
        for item, text in items:
            v = cut(text)
            n = min(13, len(v))
            grams = {tuple(v[a:a + n]) for a in range(len(v) - n + 1)} if n else set()
            for a in range(len(w) - n + 1 if n else 0):
                if tuple(w[a:a + n]) in grams:
                    hit.update(range(a, a + n))
                    ids.add(str(item))
        want.append((i is None, i or 0, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == sorted(want)


def brute_spans(rows, length):
    seen, out = set(), {}
    for i in sorted(first_texts(rows)):
        b = first_texts(rows)[i].encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(b[s:s + length])
        out[i] = bytes(np.frombuffer(b, np.uint8)[~gone])
    return out


@pytest.mark.parametrize("hot", [2048, 2])
def test_suffix_dedup(spark, monkeypatch, hot):
    """Also with every gram taken for hot, so that it is dealt over several parts."""
    monkeypatch.setattr(suffix_dedup, "HOT_GRAM", hot)
    monkeypatch.setattr(suffix_dedup, "PART_SUFFIXES", 16)
    rows = corpus()
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).collect()
    want = brute_spans(rows, 100)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert not r.removed_spans
        else:
            assert bytes(r.kept) == want[r.doc_id], r.doc_id
            assert r.n_bytes - sum(s.end - s.start for s in r.removed_spans) == len(r.kept)
    assert suffix_dedup.suffix_dedup(frame(spark, [])).count() == 0


def test_suffix_dedup_of_a_text_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    rng = random.Random(8)
    long = prose(rng, 900)
    rows = [(1, long), (2, prose(rng, 20) + long[900:2500] + prose(rng, 20)), (3, long[100:4000])]
    want = brute_spans(rows, 100)
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.suffix_dedup(frame(spark, rows)).collect()} == want


def test_loser_tree_merges_with_prefix_lengths():
    rng = random.Random(4)
    runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(0, 8))).encode() for _ in range(rng.randint(0, 30))) for _ in range(7)]
    got = list(suffix_dedup.merge_runs([suffix_dedup.front_decode(*suffix_dedup.front_code(r)) for r in runs]))
    assert [t for _, _, t in got] == sorted(t for r in runs for t in r)
    assert all(n == suffix_dedup.shared_prefix(a[2], b[2]) for a, b, n in zip(got, got[1:], [g[0] for g in got[1:]]))


@pytest.mark.parametrize("shingle,block", [(4, 256), (5, 2)])
def test_near_duplicates(spark, monkeypatch, shingle, block):
    monkeypatch.setattr(minhash.across_groups, "__defaults__", (block,))
    rows = corpus()
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(spark, rows), shingle=shingle).collect()}
    sets = {}
    for i, t in first_texts(rows).items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[a:a + shingle]) for a in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())
    least = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(30):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    for i, s in sets.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), least[i], least[i] == i), i
    assert got[None].component_id is None and got[None].kept
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


def plain_units(text, n):
    lines = [line.lower().split() for line in (text or "").split("\n")]
    for i in range(len(lines)):
        for j in range(i, len(lines)):
            words = [w for line in lines[i:j + 1] for w in line]
            if lines[i] and len(words) >= n:
                yield i, j, tuple(words)
                break


def plain_line_dedup(rows, n):
    """Units compared with all others: those of lesser doc_id, and earlier ones of the same row."""
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        mine, gone = list(plain_units(text, n)), set()
        for at, (a, b, words) in enumerate(mine):
            before = i is not None and any(words == w for j, t in rows if j is not None and j < i for _, _, w in plain_units(t, n))
            if before or any(words == w for _, _, w in mine[:at]):
                gone.update(range(a, b + 1))
        lines = text.split("\n")
        out.append((i, "\n".join(line for k, line in enumerate(lines) if k not in gone), len(lines), len(gone)))
    return out


def test_line_dedup(spark):
    rng = random.Random(8)
    pool = [prose(rng, rng.choice([1, 2, 3, 4, 7])) for _ in range(8)] + ["", " "]
    rows = [(rng.randrange(30), "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for _ in range(40)]
    rows += [(3, "One two three four five.\nshort\nshort\nunique line of five words here"), (1, "a line\nONE  two three four five."), (2, None), (5, ""), (50, "x\n" * 20),
             (None, "one two three four five.\none two three four five."), (4, "x y z a b\n\nx y z a b\nshort"), (60, "\n" * 5), (61, " \t\nx  Y z a b\n")]
    for n in (5, 13):
        got = substring.substring_dedup(frame(spark, rows).withColumn("n_lines", F.lit("mine")), n).collect()
        key = lambda r: (r[0] is None, r[0] or 0, str(r))
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=key) == sorted(plain_line_dedup(rows, n), key=key)
        for r in got:
            if r.text:
                assert any("\n".join(t[s.start:s.end] for s in r.kept_spans) == r.text for i, t in rows if i == r.doc_id and t is not None)
    assert substring.substring_dedup(frame(spark, [])).count() == 0


def test_line_dedup_of_a_long_text(spark):
    line = "the same fourteen words stand on every line of this text again and again"
    long = "\n".join([line] * 60_000)  # over a slice
    got = {r.doc_id: r for r in substring.substring_dedup(frame(spark, [(1, long), (2, "short\n" + line)])).collect()}
    assert got[1].text == line and got[1].n_removed == 59_999 and got[2].text == "short"


def plain_passage_words(rows, n):
    """(row, word number) of the words of passages that stand earlier, and each row's words as they are spelled."""
    spelled = [re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "") for _, t in rows]
    seen, gone = {}, set()
    for k in sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0)):
        w, own = [x.lower() for x in spelled[k]], set()
        for p in range(len(w) - n + 1):
            key, i = tuple(w[p:p + n]), rows[k][0]
            if key in own or i is not None and seen.get(key, i) < i:
                gone.update((k, q) for q in range(p, p + n))
            own.add(key)
            if i is not None:
                seen.setdefault(key, i)
    return gone, spelled


def test_passages_are_cut_inside_lines(spark):
    rng = random.Random(17)
    shared = [prose(rng, 60), prose(rng, 55).replace(" ", "\n", 3), prose(rng, 24)]
    rows = [(i, ". ".join([prose(rng, 10 + i % 7), shared[i % 3], prose(rng, 12), shared[(i * 5) % 3].title(), prose(rng, 9) + "!"])) for i in range(24)]
    rows += [(50, None), (51, ""), (None, shared[0] + " x " + shared[0]), (None, shared[0]), (60, shared[0] + ",\n" + shared[0]), (60, "other " + shared[1]), (61, "é " + shared[0] + " ü")]
    gone, spelled = plain_passage_words(rows, 25)
    got = substring.passage_dedup(frame(spark, rows), min_words=10_000).collect()  # no unit is so long: passages alone
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    want = [(i, [w for q, w in enumerate(spelled[k]) if (k, q) not in gone]) for k, (i, _) in enumerate(rows)]
    assert sorted([(r.doc_id, find(r.text or "")) for r in got], key=key) == sorted(want, key=key) and len(gone) > 1000
    assert [r.text for r in got if r.doc_id == 50] == [None] and substring.passage_dedup(frame(spark, [])).count() == 0


def test_a_text_that_repeats_itself_counts_once():
    one = np.array([5, 5, 7, 5, 7], dtype=np.int64)
    assert sorted(substring.once_a_row(np.array([0, 0, 0, 1, 1]), one, one * 2).tolist()) == [0, 2, 3, 4]
    assert len(substring.once_a_row(one[:0], one[:0])) == 0


def test_passage_dedup_cuts_all_that_line_dedup_cuts(spark):
    rng = random.Random(18)
    lines = [prose(rng, n) for n in (13, 14, 20, 5, 6, 9, 30)]
    rows = [(i, "\n".join(rng.choice(lines) if rng.random() < 0.5 else prose(rng, rng.randint(1, 24)) for _ in range(8))) for i in range(20)]
    by_line = {r.doc_id: r.text for r in substring.substring_dedup(frame(spark, rows)).collect()}
    both = {r.doc_id: r.text for r in substring.passage_dedup(frame(spark, rows)).collect()}
    alone = {r.doc_id: r.text for r in substring.passage_dedup(frame(spark, rows), n=10_000).collect()}
    assert alone == by_line and all(len(both[i]) <= len(by_line[i]) for i in both) and by_line != dict(rows)


def test_language_id(spark):
    rng = random.Random(6)
    make = {"aa": "bdgaeo", "bb": "ptkiuy", "cc": "mnléèo", "dd": "szxaiw"}
    word = lambda k: "".join(rng.choice(make[k]) for _ in range(rng.randint(2, 7)))
    rows = [(i, " ".join(word(k) for _ in range(rng.randint(3, 40))), k) for i, k in enumerate(list(make) * 60)]
    docs = spark.createDataFrame(rows + [(900, None, "aa"), (901, "123 !!", "bb"), (902, "", None), (None, "bdgaeo bdga", None)], "doc_id long, text string, lang string")
    docs = docs.withColumn("held", langid.held_out()).withColumn("lang_score", F.lit("clash"))
    got = langid.identify(docs, langid.train(docs.filter("not held"))).collect()
    known = [r for r in got if r.held and r.doc_id is not None and r.doc_id < 900]
    assert len(known) > 30 and np.mean([r.lang == r.lang_pred for r in known]) > 0.95
    assert {r.lang_pred for r in got if r.doc_id in (900, 901, 902)} == {"und"} and all(0 <= r.lang_score <= 1 for r in got)
    assert len(got) == docs.count()
    none = langid.identify(docs, langid.train(docs.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_codewords_are_distinct():
    for n in (0, 1, 2, 4, 6, 9, 40):
        codes = langid.codewords(n)
        assert len({tuple(c) for c in codes.tolist()}) == n or n == 1


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((40, 16))
    x = np.concatenate([centres, centres + 0.15 * rng.standard_normal((40, 16)), np.repeat(centres[:1], 30, axis=0), 3 * centres[:2]]).astype(np.float32)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)] + [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [1.0, None] + [0.0] * 14, 1), (904, [float("inf")] + [0.0] * 15, 1), (905, [], 1), (None, x[0].tolist(), 1)]
    got = {r.vec_id: r for r in embed_dedup.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, t int")).collect()}
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    true = (y @ y.T >= 0.95) & ~np.eye(len(y), dtype=bool)
    n = np.array([got[i].n_links for i in range(len(y))])
    assert (n <= true.sum(1)).all() and n.sum() >= 0.9 * true.sum() and n[0] >= 31
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in (900, 901, 902, 903, 904, 905))
    assert got[None].component_id is None
    assert {got[i].component_id for i in range(80, 110)} == {0}


def test_token_counts(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer, models

    path = P.path("piece_bpe_32k.model")
    pieces = token_counts.vocabulary(path)
    low = min(s for _, s in pieces)
    whole = Tokenizer(models.Unigram([("<unk>", 0.0)] + [(f"<0x{i:02X}>", low) for i in range(256)] + list(pieces), 0, True))
    rows = corpus() + [(600, "a  b   c"), (601, "\n\n x"), (602, "😀😀 a 日本語"), (603, "tab\tx  "), (604, "a" * 5000)]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in token_counts.token_counts(frame(spark, rows), path).collect()))
    want = sorted((i is None, i or 0, len(whole.encode("▁" + t.replace(" ", "▁")).ids) if t else 0) for i, t in rows)
    assert got == want


def test_chat_folding_and_round_trip(spark):
    events = [(1, 1, 1, "message", "user", "hi <|im_end|> & [INST] &lt;"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", None, "Hel"), (1, 4, 2, "delta", None, "lo"),
              (1, 5, 2, "regenerate", None, "Bye"), (1, 6, 2, "delta", None, "!"), (1, 7, 1, "edit", None, "hello"), (1, 8, 3, "message", "user", "gone"), (1, 9, 3, "delete", None, None),
              (2, None, 1, None, "assistant", None), (None, 1, 1, "delta", "assistant", "x\n<s>")]
    log = spark.createDataFrame(events, "conv_id long, seq long, message long, kind string, role string, text string").withColumn("start", F.lit(1))
    final = chat.fold_events(log)
    assert sorted((r.conv_id or 0, r.position, r.role, r.text) for r in final.collect()) == [(0, 1, "assistant", "x\n<s>"), (1, 1, "user", "hello"), (1, 2, "assistant", "Bye!"), (2, -(1 << 62), "assistant", "")]
    read = {r.conv_id: r for r in chat.read_back(chat.render(final)).collect()}
    assert [(t.role, t.text) for t in read[1].turns] == [("user", "hello"), ("assistant", "Bye!")] and read[1].loss_texts == ["Bye!"]
    assert read[None].loss_texts == ["x\n<s>"] and "<s>" not in read[None].formatted
    rows = [(i, t, rng_role, text) for i in range(4) for t, (rng_role, text) in enumerate([("user", "</s>[INST] ok [/INST]"), ("assistant", "é&amp;&lt;<|im_start|>"), (None, None), ("a\nb<", "x")])]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.format_conversations(table)).collect():
        assert [(t.role, t.text) for t in r.turns] == [(a or "", b or "") for _, _, a, b in rows[:4]] and r.loss_texts == ["é&amp;&lt;<|im_start|>"]
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_quality(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = prose(rng, rng.randint(10, 60)).split()
        if toxic:
            for bad in rng.sample(["vile" + c for c in "abcdefg"], 3):
                words.insert(rng.randrange(len(words)), bad)
        rows.append((i, " ".join(words), f"h{i % 5}" if i % 50 else None, "p"))
        labels += [(i, 1, int(toxic))] if i < 400 else []
    docs = spark.createDataFrame(rows + [(None, None, "h1", None), (700, "", "new", "p")], "doc_id long, text string, source string, lang string").withColumn("host", F.lit("clash"))
    got = {r.doc_id: r for r in quality.classify(docs, spark.createDataFrame(labels + [(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 602
    assert np.mean([got[i].kept == (i % 6 != 0) for i in range(400, 600)]) > 0.97 and got[None].kept and got[700].kept
    blank = quality.classify(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(blank) == 602 and all(r.kept for r in blank)


def test_shrinkage_moves_sparse_sites_to_their_centre(spark):
    sites = spark.createDataFrame([("big", 1000, 500), ("small", 2, 2), ("low", 1000, 20), ("mid", 1000, 200)], "s string, n long, pos long")
    got = {r.s: r.rate for r in quality.shrunk(sites, F.lit(0.24), "rate").collect()}
    assert abs(got["big"] - 0.5) < 0.02 and abs(got["low"] - 0.02) < 0.02 and got["small"] < 0.8
