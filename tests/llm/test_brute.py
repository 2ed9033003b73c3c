"""Each operator against a plain version of what it must compute."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
import zstandard

import corpus_pipeline
from barloom.llm import byte_bpe, components, decontaminate, quality_model, quality_rules, simhash, substring_dedup, toxicity
from barloom.llm import warc_bundles
from barloom.llm.queries import ORACLE, QUERIES
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name]) == []


def groups(n, pairs):
    root = list(range(n))

    def up(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = up(a), up(b)
        root[max(a, b)] = min(a, b)
    return [up(x) for x in range(n)]


# -- simhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", "One", "Two Ä words", "a b c", "a b c d a b c", "x\x1fy z\tw \x85 q"])
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) == plain_fingerprint(text)


def near_values(seed, n=400):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(n // 4)] + [0, 2**64 - 1]
    out = set(base)
    while len(out) < n:
        v = rng.choice(base)
        for _ in range(rng.randint(0, 5)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return np.array(sorted(out), np.uint64)


def near_pairs(values, budget=3):
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= budget
    return {(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)}


@pytest.mark.parametrize("seed", range(3))
def test_walk_finds_each_pair_once(seed, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 64)
    values = near_values(seed)
    found = [p for i, j in simhash.walk(values, values, True, 0, 3) for p in zip(i.tolist(), j.tolist(), strict=True)]
    assert len(found) == len(set(found)) and set(found) == near_pairs(values)


@pytest.mark.parametrize("depth,part", [(0, 1 << 18), (6, 1 << 18), (3, 20), (1, 50)])
def test_links_connect_what_is_near(spark, depth, part):
    values = near_values(9)
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fingerprint bigint")
    at = {int(v): k for k, v in enumerate(values.view(np.int64))}
    edges = [(at[r.a], at[r.b]) for r in simhash.links(frame, 3, depth, part).collect()]
    assert all(int(values[a] ^ values[b]).bit_count() for a, b in edges)
    assert groups(len(values), edges) == groups(len(values), near_pairs(values))


def test_simhash_groups(spark, docs_of):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(60)]
    texts += [t.upper() for t in texts[:10]] + [t + " tail" for t in texts[10:30]] + [None, ""]
    prints = np.array([plain_fingerprint(t or "") for t in texts], np.uint64)
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if int(prints[i] ^ prints[j]).bit_count() <= 3]
    want = {(i, f"{int(p):016x}", r) for i, (p, r) in enumerate(zip(prints, groups(len(texts), pairs), strict=True))}
    got = simhash.simhash_groups(docs_of(texts)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == want
    kept = {r.doc_id for r in simhash.keep_one_of_each(docs_of(texts)).collect()}
    assert kept == {c for _, _, c in want}


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_components(spark, kind):
    rng, n = random.Random(2), 120
    edges = {
        "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(70)],
        "path": [(i, i + 1) for i in range(n - 1)],
        "star": [(n - 1, i) for i in range(n - 1)],
        "none": [],
    }[kind]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = groups(n, edges)
    assert got == {x: want[x] for e in edges for x in e if any(a != b for a, b in edges if x in (a, b))}


# -- quality rules


def plain_repeats(words):
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)})


def test_repeated_words():
    rng = random.Random(1)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        assert quality_rules.repeated_words(words) == plain_repeats(words)


def test_quality_counts():
    text = "One two\x0bthree # $\n \nOne two\nOne two\n \n \r\n"
    m = dict(zip(quality_rules.FIELDS, quality_rules.measure(text, quality_rules.CompressionBands(), zstandard.ZstdCompressor()), strict=True))
    assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"]) == (11, 27, 2, 1)


def test_bands_reject_repeats_and_noise(spark, docs_of):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choices(words, k=n)) for n in (30, 300, 3000)]
    repeated = ["again and once more the very same words " * n for n in (8, 80, 800)]
    noise = ["".join(chr(rng.randrange(33, 0x2000)) + " " * (rng.random() < 0.2) for _ in range(n)) for n in (200, 4000)]
    got = quality_rules.quality_measures(docs_of(prose + repeated + noise)).collect()
    assert [r.quality_measures.in_band for r in got] == [True] * 3 + [False] * 5


# -- decontamination


def edit_distance_within(piece, text):
    """Least edits of ``piece`` to any part of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(piece, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_decontamination_is_complete():
    rng = random.Random(7)
    alphabet = "abcde "
    items = [(k, "".join(rng.choices(alphabet, k=rng.randint(20, 60))).strip() + "xyz") for k in range(6)]
    settings = decontaminate.PassageSearch(q=3, piece=24, stride=12, rate=0.2, least=10, step=4)
    pieces = decontaminate.Pieces(items, settings)
    hits = 0
    for _ in range(60):
        _, item = rng.choice(items)
        passage = list(item)
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(passage))
            passage[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "a"])
        text = "".join(rng.choices(alphabet, k=30)) + "".join(passage) + "".join(rng.choices(alphabet, k=30))
        plain = decontaminate.normalised(text)[0]
        want = {
            pieces.item[p] for p in range(len(pieces.texts))
            if edit_distance_within(pieces.texts[p].tolist(), plain.tolist()) <= pieces.edits[p]
        }
        got = list(pieces.search(text))
        assert {x[0] for x in got} == want
        hits += len(want)
        for _, _, _, start, end in got:
            assert 0 <= start < end <= len(text)
    assert hits > 40


def test_decontamination_of_edited_passages(spark, docs_of):
    item = "The quick brown foxes of Zürich jumped over eleven lazy dogs, and then they slept until the following Tuesday."
    other = "nothing here belongs to any benchmark at all, it is only a long enough sentence about weather in the north"
    bench = spark.createDataFrame([(1, item)], "item_id int, text string")
    edited = other + "\n" + item.upper().replace("LAZY", "LASY").replace(" AND", "\n  AND") + other
    rows = decontaminate.contaminated(docs_of([other, item, edited]), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(1, 1), (2, 1)]
    span = next(edited[r.start : r.end] for r in rows if r.doc_id == 2)
    assert span.startswith("THE QUICK") and span.endswith("TUESDAY.")
    small = decontaminate.PassageSearch(block=20)  # a block for each item
    both = spark.createDataFrame([(1, item), (2, other)], "item_id int, text string")
    assert decontaminate.contaminated(docs_of([item + other]), both, settings=small).count() == 2


# -- substring dedup


def test_pieces_resist_insertions():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(3000)]
    passage = " ".join(words[:60])
    one, two = " ".join(words[60:400]) + " " + passage, "ÿ inserted " + passage + " " + " ".join(words[500:900])
    settings = substring_dedup.Chunking()
    a, b = (set(zip(*substring_dedup.pieces(t, settings)[:2], strict=True)) for t in (one, two))
    assert len(a & b) >= 4


def test_passages_are_found_and_clean_documents_left_alone(spark, docs_of):
    rng = random.Random(6)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))

    passages = [prose(55) for _ in range(20)]
    carrying = [f"{prose(80)} {p} {prose(40)}" for p in passages for _ in range(2)]
    rows = substring_dedup.repeated_passages(docs_of(carrying + [prose(200) for _ in range(40)])).collect()
    assert {(r.first_doc_id, r.doc_id) for r in rows} == {(2 * k, 2 * k + 1) for k in range(20)}
    for r in rows:
        assert carrying[r.doc_id][r.start : r.stop] in carrying[r.first_doc_id]


# -- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def codec(ranks):
    return byte_bpe.Codec(byte_bpe.tokenizer_json(ranks, public_tokenizers.PATTERN), public_tokenizers.PATTERN)


def odd_texts(n):
    rng, letters = random.Random(8), "ab  \n\t\r'sStd1é \x1c\x85　中文🎉!-_́٣ <|endoftext|>"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)] + ["<|endoftext|>", " " * 300]


def test_encoding_is_that_of_tiktoken(ranks, codec, monkeypatch):
    monkeypatch.setattr(codec.seen, "most", 500)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = odd_texts(4000)
    got = [x.tolist() for at in range(0, len(texts), 256) for x in codec.encode(texts[at : at + 256])]
    assert got == [own.encode_ordinary(t) for t in texts]
    assert all(codec.to_bytes(np.array(x, np.int64)).tobytes().decode() == t for x, t in zip(got, texts, strict=True))


def test_offsets_are_those_of_the_library(codec):
    for encoding in codec.tokenizer.encode_batch(odd_texts(500), add_special_tokens=False):
        if encoding.ids:
            starts, ends = codec.offsets(np.array(encoding.ids))
            assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == encoding.offsets


def test_decoding_of_split_characters(spark):
    bpe = byte_bpe.ByteBPE(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = bpe.encode(spark.createDataFrame([("a🦄",)], "text string"), offsets=True).select("ids.*").first()
    assert ids.ends[-1] == 2 and ids.starts[-1] == 1
    frame = spark.createDataFrame([(ids.ids,), (ids.ids[:-1],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(frame, as_text=True).collect()][0] == "a🦄"
    assert [r.decoded for r in bpe.decode(frame, as_text=True).collect()][1].startswith("a�")
    assert [bytes(r.decoded) for r in bpe.decode(frame).collect()][2:] == [b"", b""]
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([60_000],)], "ids array<int>")).collect()


# -- WARC


def test_bundles_are_plain_zstandard(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 200) for i in range(50)], "page_id bigint, url string, html string")
    warc_bundles.write_bundles(pages.coalesce(1), str(tmp_path / "w"), settings=warc_bundles.Bundles(frame_bytes=4000)).count()
    (file,) = (tmp_path / "w").glob("*.warc.zst")
    data = file.read_bytes()
    table = warc_bundles.read_seek_table(data)
    assert len(table) > 5
    reader = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True)
    whole = reader.read()
    assert len(whole) == sum(raw for _, _, raw in table)
    assert sum(1 for _ in warc_bundles.records(whole)) == 50
    assert {hashlib.sha1(b.split(b"\r\n\r\n", 1)[1]).hexdigest() for *_, b in warc_bundles.records(whole)} == {
        hashlib.sha1((f"<p>{i}</p>" * 200).encode()).hexdigest() for i in range(50)
    }


# -- classifiers


def test_pairs_in_linear_time():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(50, 5)).astype(np.float32)
    at, x = np.arange(10), rng.normal(size=10).astype(np.float32)
    plain = weights[-1, 0] + weights[at, 0] @ x
    plain += sum(weights[i, 1:] @ weights[j, 1:] * x[i] * x[j] for i, j in itertools.combinations(range(10), 2))
    assert quality_model.raw_score(weights, at, x)[0] == pytest.approx(float(plain), rel=1e-4)


def corpus(n, seed):
    """Texts and labels: every fourth has some of a few marked words."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(300)]
    bad = ["zurgle", "qwibbet", "vextor"]
    rows = []
    for k in range(n):
        text = rng.choices(words, k=rng.randint(20, 120))
        for _ in range(6 if k % 4 == 0 else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((k, " ".join(text), int(k % 4 == 0)))
    return rows


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_model, "quality")])
def test_held_out_accuracy(spark, docs_of, module, label):
    rows = corpus(800, 3)
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], f"doc_id bigint, {label} int")
    docs = docs_of([(k, t) for k, t, _ in rows])
    model = module.train(docs, labels, label=label)
    score = {r.doc_id: r.score for r in model.scored(docs).collect()}
    held = [(score[k], y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.9
    again = module.train(docs.repartition(5), labels, label=label)
    assert all(abs(score[r.doc_id] - r.score) < 1e-9 for r in again.scored(docs).collect())


# -- pipeline


def test_pipeline_against_plain_python(spark, ranks):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rules, press = quality_rules.CompressionBands(), zstandard.ZstdCompressor(level=3)
    left = []
    for r in docs:
        words, data = r.text.encode().split(), r.text.encode()
        if len(words) < 10 or 100 * plain_repeats(words) > 20 * len(words):
            continue
        chunks = [data[i : i + 4096] for i in range(0, len(data), 4096)] if len(data) > 4096 else []
        bad = sum(not rules.fits(len(c), len(press.compress(c)) / len(c)) for c in chunks)
        if rules.fits(len(data), len(press.compress(data)) / len(data)) and bad <= 0.25 * len(chunks):
            left.append((r.doc_id, r.source, r.text))
    total, seen = Counter(s for _, s, _ in left), Counter()
    for _, s, t in left:
        seen.update({(s, x.strip(" \t\x0b\x0c\r")) for x in t.split("\n")})
    gone = {k for k, n in seen.items() if k[1] and n >= 5 and n > 0.1 * total[k[0]]}
    left = [(d, "\n".join(x for x in t.split("\n") if (s, x.strip(" \t\x0b\x0c\r")) not in gone)) for d, s, t in left]
    prints = [plain_fingerprint(t) for _, t in left]
    near = [(i, j) for i, j in itertools.combinations(range(len(left)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3]
    first = {}
    for (d, t), g in zip(left, groups(len(left), near), strict=True):
        first[g] = min(first.get(g, (d, t)), (d, t))
    pieces = decontaminate.Pieces(items, decontaminate.PassageSearch())
    kept = {}
    for d, t in first.values():
        plain = decontaminate.normalised(t)[0].astype("<u4").tobytes().decode("utf-32-le")
        exact = any(p.astype("<u4").tobytes().decode("utf-32-le") in plain for p in pieces.texts)
        if not exact:
            kept[d] = t
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {d: hashlib.sha256(" ".join(map(str, own.encode_ordinary(t))).encode()).hexdigest() for d, t in kept.items()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()} == want
