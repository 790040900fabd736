import random

from spoolway.llm import chunks


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_cuts_cover_the_text_and_follow_content():
    rng = random.Random(1)
    text = prose(rng, 400).encode()
    at = chunks.cuts(text)
    assert at[0] == 0 and at[-1] == len(text) and at == sorted(set(at))
    moved = chunks.cuts(b"a few words more " + text)
    shifted = {p - 17 for p in moved}
    assert len(shifted & set(at)) > 0.9 * len(at)
    assert chunks.cuts(b"") == [] and chunks.cuts(b"a") == [0, 1]
    long = chunks.cuts("日本".encode() * 2000)
    assert all(("日本".encode() * 2000)[p] & 0xC0 != 0x80 for p in long[:-1])
    assert max(b - a for a, b in zip(long, long[1:])) <= chunks.MOST_BYTES + 2 * chunks.SNAP_BYTES


def brute(rows, min_words):
    """All earlier documents' digests, one set after the other."""
    texts = {}
    for r in rows:
        if r["doc_id"] is not None:
            texts.setdefault(r["doc_id"], []).append((r["text"] or "").encode())
    out, seen = {}, set()
    for i in sorted(texts):
        own = set()
        for t in texts[i]:
            out[i, t] = chunks.repeated_runs(t, seen, min_words)
            own |= set(chunks.chunk_digests(t)[1])
        seen |= own
    return out


def test_result_equals_brute_force(docs, rows):
    want = brute(rows, 25)
    found = chunks.dedup_substrings(docs)
    assert found.columns == [*docs.columns, "dedup"]
    got = found.collect()
    assert len(got) == len(rows)
    cut = 0
    for r in got:
        d, text = r["dedup"], (r["text"] or "").encode()
        spans = [(s["start"], s["end"]) for s in d["spans"]]
        if r["doc_id"] is not None:
            assert (d["n_chunks"], d["n_dup_chunks"], spans) == want[r["doc_id"], text]
        kept = bytes(c for i, c in enumerate(text) if not any(a <= i < b for a, b in spans)).decode()
        assert d["kept_text"] == (None if r["text"] is None else kept)
        cut += bool(spans)
    assert cut >= 3  # the copies and the repeated word


def test_passages_of_over_fifty_words_are_cut(spark):
    rng = random.Random(3)
    shared = [prose(rng, n) for n in range(55, 95, 2)]
    rows = []
    for k, p in enumerate(shared):
        rows += [(2 * k, f"{prose(rng, 80)} {p} {prose(rng, 60)}"), (2 * k + 1, f"{prose(rng, 33)} {p} {prose(rng, 90)}")]
    rows += [(1000 + i, prose(rng, 200)) for i in range(20)]
    got = {r["doc_id"]: r["dedup"] for r in chunks.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(not got[2 * k]["spans"] for k in range(len(shared)))
    assert sum(bool(got[2 * k + 1]["spans"]) for k in range(len(shared))) >= len(shared) - 1
    assert all(not got[1000 + i]["spans"] and got[1000 + i]["kept_text"] == rows[-20 + i][1] for i in range(20))


def test_empty_table(empty):
    assert chunks.dedup_substrings(empty).count() == 0


def test_passages_without_spaces_are_cut(spark):
    rng = random.Random(6)
    block = "".join(chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(700))
    rows = [(1, block), (2, "甲" + block), (3, "".join(chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(700)))]
    got = {r.doc_id: r.dedup for r in chunks.dedup_substrings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert not got[1].spans and not got[3].spans
    assert sum(s["end"] - s["start"] for s in got[2].spans) > 0.8 * len(block.encode())
