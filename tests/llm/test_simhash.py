from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from hearthspark.llm import queries, simhash
from hearthspark.llm.components import components
from tests.llm.data import SMALL, documents, given


def plain_fingerprint(text: str | None) -> int:
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(values: list[int]) -> dict[int, int]:
    """The smallest value reachable from each by steps of at most four bits."""
    owner = {v: v for v in values}
    distinct = sorted(owner)
    changed = True
    while changed:
        changed = False
        for a in distinct:
            for b in distinct:
                if (a ^ b).bit_count() <= 4 and owner[b] < owner[a]:
                    owner[a], changed = owner[b], True
    return owner


def test_fingerprints():
    texts = ["", None, "one", "A b C d", "a b c d e f g", "a  b\tc\x0bd é ü", "x y " * 400, "a b c d " * 9 + "\x85 \x1f",
             " ".join(map(str, range(70_000)))]
    assert [simhash.fingerprint((t or "").encode()) for t in texts] == [plain_fingerprint(t) for t in texts]


def near(draw: random.Random, value: int, most: int) -> int:
    for bit in draw.sample(range(64), draw.randint(0, most)):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("tile", [3, 4096])
def test_links_connect_what_is_near(spark, tile):
    draw = random.Random(tile)
    values = {draw.getrandbits(64) for _ in range(40)}
    values |= {near(draw, v, 5) for v in list(values) for _ in range(4)}
    values |= {1 << i for i in range(12)} | {0, (1 << 64) - 1}
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    found = simhash.links(spark.createDataFrame(signed, "bits long"), tile)
    joined = {r["node"] % (1 << 64): r["component"] % (1 << 64) for r in components(found).collect()}
    expected = groups(list(values))
    by_own: dict[int, set[int]] = {}
    by_found: dict[int, set[int]] = {}
    for v in values:
        by_own.setdefault(expected[v], set()).add(v)
        by_found.setdefault(joined.get(v, v), set()).add(v)
    assert sorted(map(sorted, by_own.values())) == sorted(map(sorted, by_found.values()))


def test_any_four_bits_share_a_key_and_a_chain():
    draw = random.Random(5)
    masks = [[simhash.part_masks((s + 1) % 5), simhash.SEGMENTS[s]] for s in range(5)]
    for _ in range(3000):
        differing = near(draw, 0, 4)
        assert any(
            differing >> first & ((1 << size) - 1) == 0 and any(differing & mask == 0 for mask in parts)
            and all((differing & int(mask)).bit_count() <= budget for mask, budget in simhash.chain_masks(start))
            for start, (parts, (first, size)) in enumerate(masks))


def expected_rows(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    owner = groups(prints)
    smallest: dict[int, int | None] = {}
    for (doc, _), v in zip(rows, prints, strict=True):
        ids = [i for i in (smallest.get(owner[v]), doc) if i is not None]
        smallest[owner[v]] = min(ids, default=None)
    return sorted((-1 if doc is None else doc, f"{v:016x}", smallest[owner[v]]) for (doc, _), v in zip(rows, prints, strict=True))


def test_documents(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(i, base.replace(f"word{i * 7} ", "changed ")) for i in range(1, 40)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, base), (103, base), (None, base), (104, "other words here"),
             (105, "OTHER words  here"), (None, "alone without an id"), (106, "long " * 100_000)]
    docs = documents(spark, rows, clash="fingerprint")
    found = simhash.near_duplicates(docs).collect()
    assert sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in found) == expected_rows(rows)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "no id here"),
            (None, "no id here"), (9, None), (8, "")]
    docs = documents(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [
        (-1, "no id here"), (2, "a b c d e f"), (8, "")]


def test_all_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in given(spark, "documents").collect()]
    found = queries.op8_simhash(spark, SMALL).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == expected_rows(rows)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {r["node"]: r["component"] for r in components(edges).collect()} == {
        **{i: 0 for i in range(61)}, 100: 100, 101: 100}
