"""Each stage of the pipeline, and the whole run, against plain versions on a whole small table."""

import math
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from lawloom.llm import langid, mixing
from lawloom.llm import queries as q
from tests_plain import components, crc, tokenizer

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The table before and after each stage, each stage run on what the one before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, folder = {"documents": docs}, tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"file://{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"file://{folder}/{name}")
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_language(stages):
    model = langid.fit_language_model(stages["documents"])
    want = []
    for r in rows(stages["documents"]):
        name, score = model.predict(r["text"])
        if name != "und" and score >= 0.5:
            want.append(r)
    assert sorted(map(str, rows(stages["language_id"]))) == sorted(map(str, want)) and len(want) > 150


def test_near_duplicates(stages):
    """All pairs of five-word sets; the least doc_id of each group stays, rows unchanged."""
    docs = rows(stages["language_id"])
    sets = {}
    for r in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (n := len(sets[a] & sets[b])) and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    kept = {i for i, c in components(ids, links).items() if i == c}
    assert sorted(map(str, rows(stages["minhash_dedup"]))) == sorted(str(r) for r in docs if r["doc_id"] in kept) and links


def test_passages(stages):
    """Bytes in strings of the stage's length that begin elsewhere too are gone; what is left are whole characters."""
    n = corpus_pipeline.PASSAGE_BYTES
    docs = {r["doc_id"]: r for r in rows(stages["minhash_dedup"])}
    data = {i: (r["text"] or "").encode() for i, r in docs.items()}
    often = Counter(hash(t[i : i + n]) for t in data.values() for i in range(len(t) - n + 1))
    changed = 0
    for r in rows(stages["suffix_dedup"]):
        t = data[r["doc_id"]]
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if often[hash(t[i : i + n])] > 1:
                gone[i : i + n] = b"\x01" * n
        # a character goes whole where any of its bytes does
        want = "".join(ch for ch, a, b in _characters(t) if not any(gone[a:b]))
        assert r["text"] == want or r["text"] == bytes(x for x, g in zip(t, gone, strict=True) if not g).decode(errors="ignore")
        assert r["n_chars"] == len(r["text"]) and {k: v for k, v in r.items() if k not in ("text", "n_chars")} == {k: v for k, v in docs[r["doc_id"]].items() if k not in ("text", "n_chars")}
        changed += r["text"] != docs[r["doc_id"]]["text"]
    assert changed > 0 and len(data) == stages["suffix_dedup"].count()


def _characters(data):
    at = 0
    for ch in data.decode():
        size = len(ch.encode())
        yield ch, at, at + size
        at += size


def plain_targets(sizes):
    """Sources in order share the whole by weights 1, 2, 3 in turn; none takes over three times its size, the rest is dealt again."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**full, **share}
        full |= {s: 3.0 * sizes[s] for s in over}


def test_mixing(stages):
    """Rows come as often as the mix takes them: whole copies by source, one more for what hashes low, and sums near the targets."""
    docs = rows(stages["suffix_dedup"])
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs}
    sources = defaultdict(list)
    for r in docs:
        sources[r["source"]].append(r["doc_id"])
    target = plain_targets({s: sum(size[i] for i in ids) for s, ids in sources.items()})
    plan = {r.doc_id: r for r in mixing.mix_sources(stages["suffix_dedup"]).collect()}
    came = Counter(r["doc_id"] for r in rows(stages["mixing"]))
    texts = {r["doc_id"]: r for r in docs}
    assert all(r == texts[r["doc_id"]] for r in rows(stages["mixing"]))
    for s, ids in sources.items():
        whole = math.floor(target[s] / max(1, sum(size[i] for i in ids)) + 1e-9)
        for i in ids:
            assert plan[i].target == pytest.approx(target[s]) and plan[i].size == size[i]
            assert came[i] == (round(plan[i].taken / size[i]) if size[i] else 0)
            assert not size[i] or whole <= came[i] <= min(3, whole + 1)
        assert abs(sum(plan[i].taken for i in ids) - target[s]) <= 2
        # rounding the one part of a source to a copy moves it by half a document at most
        assert abs(sum(came[i] * size[i] for i in ids) - target[s]) <= max((size[i] for i in ids), default=0) / 2 + 2


def pieces_of(found):
    got, places = Counter(), defaultdict(list)
    for r in found:
        got[(r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])] += 1
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    return got


def check_packed(found, docs):
    """Every id of every row lies in one piece: pieces of a document, however often it comes, cover its ids as often."""
    t = tokenizer(q.WORD_BPE)
    times = Counter(r["doc_id"] for r in docs)
    ids = {r["doc_id"]: [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs}
    cover = {i: [0] * len(x) for i, x in ids.items()}
    for (doc, start, length, digest, total), k in pieces_of(found).items():
        assert total == len(ids[doc]) and digest == crc(ids[doc][start : start + length])
        for at in range(start, start + length):
            cover[doc][at] += k
    assert all(set(c) == {times[i]} for i, c in cover.items())


def test_packing(stages):
    check_packed(rows(stages["packing"]), rows(stages["mixing"]))


def test_whole_run(spark, stages):
    """run() on the folder packs what the stages one by one keep."""
    check_packed(rows(corpus_pipeline.run(spark, SF)), rows(stages["mixing"]))
