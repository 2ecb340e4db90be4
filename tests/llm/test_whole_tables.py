"""Each query of the subpackage against a brute-force version on whole small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lawloom.llm import queries as q

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def rows(df):
    return [r.asDict() for r in df.toLocalIterator()]


def table(spark, sf, name):
    return rows(spark.read.parquet(f"{sf}/{name}.parquet"))


def components(ids, pairs):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def tokenizer(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.tokenizer_path(name))
    t.encode_special_tokens = True
    return t


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark):
    t = tokenizer(q.WORD_BPE)
    want = {r["doc_id"]: [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in table(spark, SF, "documents")}
    got, seq = defaultdict(list), defaultdict(list)
    for r in rows(q.op1_packing(spark, SF)):
        got[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got.keys() == want.keys()
    for doc, pieces in got.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(want[doc]) and p["length"] > 0
            assert p["ids_crc32"] == crc(want[doc][at : at + p["length"]])
            at += p["length"]
        assert at == len(want[doc])
    for pieces in seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_op2(spark):
    t = tokenizer(q.BYTE_BPE)
    sizes = [len(t.encode(r["text"] or "", add_special_tokens=False).ids) for r in table(spark, SF, "documents")]
    got = {r["n_tokens"]: r for r in rows(q.op2_token_counts(spark, SF))}
    assert {k: r["n_docs"] for k, r in got.items()} == Counter(sizes)
    for k, r in got.items():
        assert r["docs_at_least"] == sum(s >= k for s in sizes) and r["tokens_at_least"] == sum(s for s in sizes if s >= k)
        assert r["truncated_total"] == sum(min(s, k) for s in sizes) and r["docs_cut"] == sum(s > k for s in sizes)
        assert r["tokens"] == k * r["n_docs"] and r["quantile"] == pytest.approx(sum(s <= k for s in sizes) / len(sizes))


def test_op3(spark):
    t, at = tokenizer(q.BYTE_BPE), 0
    got = {r["doc_id"]: r for r in rows(q.op3_token_files(spark, SF))}
    docs = sorted(table(spark, SF, "documents"), key=lambda r: r["doc_id"])
    assert len(got) == len(docs)
    for d in docs:
        ids = [*t.encode(d["text"] or "", add_special_tokens=False).ids, 0]
        assert got[d["doc_id"]] == {"doc_id": d["doc_id"], "start": at, "n_tokens": len(ids), "ids_crc32": crc(ids)}
        at += len(ids)


def test_op4(spark):
    vecs = {r["vec_id"]: np.array(r["embedding"], float) for r in table(spark, SF2, "embeddings")}
    ids = sorted(vecs)
    x = np.stack([vecs[i] / np.linalg.norm(vecs[i]) for i in ids])
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    comp = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(linked), strict=True)])
    want = [{"vec_id": i, "n_links": int(linked[k].sum()), "component_id": comp[i], "kept": comp[i] == i} for k, i in enumerate(ids)]
    assert sorted(rows(q.op4_near_vectors(spark, SF2)), key=lambda r: r["vec_id"]) == want


def test_op5(spark):
    got = {r["page_id"]: r for r in rows(q.op5_url_filter(spark, SF2))}
    pages = table(spark, SF2, "pages")
    assert len(got) == len(pages)
    for p in pages:
        m = re.match(r"^.*?://([^/?#]*)([^?#]*)", p["url"] or "", re.S)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        r = got[p["page_id"]]
        assert (r["host"], r["path"]) == (host, path)
        fit = [(len(t), t, v) for t, v in q.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])]
        assert r["rule"] == (max(fit)[1] if fit else None)
        if fit:
            assert r["verdict"] == max(fit)[2]
        else:
            assert r["verdict"] == ("block" if re.search("casino|bets|adult|pills", host) else "allow"), host


@pytest.mark.parametrize("sf", [SF, SF2])
def test_op6(spark, sf):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, sf, "documents")}
    seen = {n: Counter(hash(x[i : i + n]) for x in docs.values() for i in range(len(x) - n + 1)) for n in (400, q.PASSAGE_BYTES)}

    def covered(x, n):
        edge = np.zeros(len(x) + 1, int)
        for i in range(len(x) - n + 1):
            if seen[n][hash(x[i : i + n])] > 1:
                edge[i] += 1
                edge[i + n] -= 1
        return np.cumsum(edge[:-1]) > 0

    for r in rows(q.op6_suffix_dedup(spark, sf)):
        x = docs[r["doc_id"]]
        gone = covered(x, 400)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(x, np.uint8)[~gone].tobytes()
        assert r == {"doc_id": r["doc_id"], "n_bytes": len(x), "n_removed": int(gone.sum()), "n_spans": spans, "kept_sha256": hashlib.sha256(kept).hexdigest(), "n_passage_bytes": int(covered(x, q.PASSAGE_BYTES).sum())}


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def test_op7(spark):
    sets = {r["doc_id"]: shingles(r["text"], 4) for r in table(spark, SF2, "documents")}
    index, pairs = defaultdict(list), set()
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    common = Counter()
    for group in index.values():
        for n, a in enumerate(group):
            for b in group[n + 1 :]:
                common[a, b] += 1
    pairs = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    comp = components(sets, pairs)
    want = [{"doc_id": i, "n_shingles": len(s), "component_id": comp[i], "kept": comp[i] == i} for i, s in sorted(sets.items())]
    assert sorted(rows(q.op7_minhash(spark, SF2)), key=lambda r: r["doc_id"]) == want


def test_op8(spark):
    docs = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, SF, "documents")}
    by_text = {}
    for r in rows(q.op8_media(spark, SF)):
        x = docs[r["doc_id"]]
        payload = x + bytes(-len(x) % 64 or (0 if x else 64))
        assert (r["n_bytes"], r["payload_bytes"]) == (len(x), len(payload))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-64:])
        assert by_text.setdefault(x, (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])


def test_op9(spark):
    docs = {r["doc_id"]: r for r in table(spark, SF2, "documents")}
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for i, r in docs.items()}
    per = Counter()
    for i, r in docs.items():
        per[r["source"]] += size[i]
    names = sorted((s for s in per if s is not None), key=lambda s: s.encode()) + [s for s in per if s is None]
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(per.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * per[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * per[s]
            left -= target[s]
        free -= over
    taken = Counter()
    for r in rows(q.op9_mixing(spark, SF2)):
        d = docs[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == per[d["source"]]
        assert r["target"] == pytest.approx(target[d["source"]]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[d["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= 5


def test_op10(spark):
    docs = {r["doc_id"]: r for r in table(spark, SF2, "documents")}
    right = n = 0
    for r in rows(q.op10_language(spark, SF2)):
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        if r["held_out"]:
            n += 1
            right += r["lang_pred"] == docs[r["doc_id"]]["lang"]
    assert right / n >= 0.97
