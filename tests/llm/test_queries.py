"""The registered queries, all columns and digests, against brute force over whole small tables with odd rows."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import test_llm as brute
from corpusmill.llm import html_text, queries

SMALL = "/root/testdata/sf0.001"


def sha256(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """The smallest tables with rows added: null and empty texts, exact copies, odd words and vectors."""
    folder = tmp_path_factory.mktemp("tables")
    own = {n: pq.read_table(f"{SMALL}/{n}.parquet") for n in ("documents", "embeddings", "pages", "benchmark")}
    first = own["documents"].slice(3, 1).to_pylist()[0]
    docs = [(9000, None), (9001, ""), (9002, "½ 12 !!"), (9003, first["text"]), (9004, "Lead words. " + first["text"]), (9005, "one Two\x0bthree"),
            (9006, "Ünï\U0001F600 token: 'abc.DEF=12' AKIA" + "Q7" * 9 + " x" + "deadbeef12" * 3 + " api_key=short apikey=sho")]
    pages = [(9000, None, None), (9001, "u", ""), (9002, "v", own["pages"].slice(2, 1).to_pylist()[0]["html"])]
    vectors = own["embeddings"].slice(0, 1).to_pylist()[0]
    odd = [(9000, None, 0), (9001, [0.0] * len(vectors["embedding"]), vectors["label"]), (9002, vectors["embedding"], None), (9003, vectors["embedding"], vectors["label"])]
    added = {
        "documents": [{"doc_id": k, "text": t, "lang": None, "source": None, "n_chars": None} for k, t in docs],
        "pages": [dict(zip(("page_id", "url", "html"), p)) for p in pages],
        "embeddings": [dict(zip(("vec_id", "embedding", "label"), v)) for v in odd],
        "benchmark": [{"item_id": 9000, "text": None}, {"item_id": 9001, "text": "!?"}, {"item_id": 9002, "text": "one two THREE"}],
    }
    out = {}
    for name, table in own.items():
        out[name] = table.to_pylist() + added[name]
        pq.write_table(pa.Table.from_pylist(out[name], table.schema.remove_metadata()), f"{folder}/{name}.parquet")
    return str(folder), out


@pytest.fixture(scope="module")
def texts(tables):
    return {r["doc_id"]: r["text"] or "" for r in tables[1]["documents"]}


def rows(spark, tables, name, key="doc_id"):
    found = queries.QUERIES[name](spark, tables[0]).collect()
    got = {r[key]: r for r in found}
    table = {"vec_id": "embeddings", "page_id": "pages"}.get(key, "documents")
    assert len(found) == len(got) and set(got) == {r[key] for r in tables[1][table]}
    return got


def test_op1(spark, tables, texts):
    for k, r in rows(spark, tables, "op1_bpe_roundtrip").items():
        ids = brute.reference.encode_ordinary(texts[k])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == sha256(texts[k].encode())


def test_op2(spark, tables):
    got = rows(spark, tables, "op2_near_vectors", "vec_id")
    data = tables[1]["embeddings"]
    able = [r for r in data if r["embedding"] is not None and r["label"] is not None and np.isfinite(r["embedding"]).all() and np.any(r["embedding"])]
    m = np.array([r["embedding"] for r in able], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = [(i, j) for i, j in zip(*np.nonzero(m @ m.T >= 0.93)) if i > j and able[i]["label"] == able[j]["label"]]
    degree = Counter(x for p in near for x in p)
    for i, r in enumerate(able):
        assert got[r["vec_id"]].n_links <= degree[i]
    assert sum(r.n_links for r in got.values()) >= 0.9 * 2 * len(near) > 0
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert [(got[k].n_links, got[k].component_id) for k in (9000, 9001, 9002)] == [(0, 9000), (0, 9001), (0, 9002)]
    assert not got[9003].kept


def test_op3(spark, tables):
    got = rows(spark, tables, "op3_warc", "page_id")
    first = {}
    for p in sorted(tables[1]["pages"], key=lambda p: p["page_id"]):
        data = (p["html"] or "").encode()
        k = first.setdefault(data, p["page_id"])
        r, revisit = got[p["page_id"]], k != p["page_id"]
        assert (r.payload_bytes, r.payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r.record_type, r.refers_to) == (("revisit", k) if revisit else ("response", None))


def test_op4(spark, tables, texts):
    got = rows(spark, tables, "op4_near_duplicates")
    keys = sorted(texts)
    sets = [brute.shingle_set(texts[k]) for k in keys]
    links = [(i, j) for i in range(len(keys)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    label = brute.brute_components(len(keys), links)
    for i, k in enumerate(keys):
        assert (got[k].n_shingles, got[k].component_id, got[k].kept) == (len(sets[i]), keys[label[i]], label[i] == i)


def test_op5(spark, tables):
    got = rows(spark, tables, "op5_html_text", "page_id")
    for p in tables[1]["pages"]:
        r = got[p["page_id"]]
        assert (r.url, r.text, r.n_chars) == (p["url"], html_text.extract(p["html"]), len(r.text))
        assert not re.search(r"</?(?:p|div|script|nav|li)\b", r.text) and all(b == " ".join(b.split()) and b for b in r.text.split("\n") if r.text)
    assert sum(r.n_chars > 0 for r in got.values()) >= 0.9 * (len(got) - 2)


def test_op6(spark, tables, texts):
    want = brute.brute_repeats(list(texts.items()), 100)
    for k, r in rows(spark, tables, "op6_repeats").items():
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (*want[k][:3], sha256(want[k][3]))


def base_spans(text):
    """The base kinds by a walk of their own: a fresh search after every match, kept or not."""
    key = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    kinds = [("assign", key + r"""["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=\-]+)""", 6), ("access", "(AKIA[A-Z0-9]+)", 20), ("hex", "([0-9a-f]+)", 24)]
    out = []
    for rank, (kind, pattern, least) in enumerate(kinds):
        at, pattern = 0, re.compile(pattern)
        while m := pattern.search(text, at):
            at = m.end()
            size = len(m[0]) if kind == "access" else len(m[1])
            if size >= least:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def test_op7(spark, tables, texts):
    for k, r in rows(spark, tables, "op7_secret_scan").items():
        want = base_spans(texts[k])
        listed = [f"{kind}:{a}:{b}" for a, _, b, kind in want]
        count = Counter(kind for *_, kind in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        assert r.base_sha256 == sha256(",".join(listed).encode())
        assert set(listed) <= set(r.spans.split(","))
    assert [kind for *_, kind in base_spans(texts[9006])] == ["assign", "access", "hex"]


def test_op8(spark, tables, texts):
    got = rows(spark, tables, "op8_lm_score")
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in texts}
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    tokens = {k: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower)), "\n"] for k, t in texts.items()}
    count = Counter(w for k, t in tokens.items() if not held[k] for w in t)
    total = sum(count.values())
    for k, t in tokens.items():
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[k], len(t), sum(count[w] > 0 for w in t), total)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in t))
        assert r.score <= 0
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_op9(spark, tables, texts):
    got = rows(spark, tables, "op9_language_id")
    stated = {r["doc_id"]: r["lang"] for r in tables[1]["documents"]}
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[k])) and r.lang_pred in {"und", *stated.values()}
    out = [k for k, r in got.items() if r.held_out and stated[k] and r.lang_pred != "und"]
    assert sum(got[k].lang_pred == stated[k] for k in out) >= 0.9 * len(out) > 0


def test_op10(spark, tables, texts):
    want = brute.brute_hits(list(texts.items()), [(r["item_id"], r["text"]) for r in tables[1]["benchmark"]])
    for k, r in rows(spark, tables, "op10_decontaminate").items():
        n, hit, items = want[k]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(items), hit > 0)
        assert r.items_sha256 == sha256(",".join(items).encode())
    assert want[9005][2] == ["9002"]
