"""op9: signatures with several components, found from entries, and the links they hide."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from siltstone.llm import jaccard

NONE = SimpleNamespace(value=np.zeros(0, np.uint64))


def variants(rng, bases, each, edits):
    """Texts made of a few bases by changing some words: many pairs just above and just below the threshold."""
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(bases):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(each):
            text = list(base)
            for place in rng.sample(range(60), rng.randint(0, edits)):
                text[place] = rng.choice(words)
            texts.append(" ".join(text))
    return texts


def shingles(text):
    words = text.split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def components(texts):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [1, 500, 10**6])
def test_entries_tell_the_torn_signatures(monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(5)
    texts = variants(rng, 3, 12, 5) + [""]
    component = [rng.choice([i, -7 - i % 3]) for i in range(len(texts))]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts), pa.array(component, pa.int64())], ["node", "text", "component"]
    )
    members = {}
    for sig, node, of in jaccard._labelled([rows.slice(0, 20), rows.slice(20)], NONE):
        for s, n, c in zip(sig.tolist(), node.tolist(), of.tolist()):
            members.setdefault(s, []).append((n, c))
    expected = {s: min(n for n, _ in m) for s, m in members.items() if len({c for _, c in m}) > 1 and len(m) > 2}
    found = {}
    blocks = pa.Table.from_batches(list(jaccard._entry_blocks(7, NONE)([rows.slice(0, 20), rows.slice(20)])))
    for s in set(blocks.column("slice").to_pylist()):
        out = jaccard._torn(blocks.filter(pc.equal(blocks.column("slice"), s)))
        found.update(zip(out.column("sig").to_numpy().view(np.uint64).tolist(), out.column("lead").to_pylist()))
    assert found == expected and expected


def test_hot_signature_sends_one_entry_per_block():
    text = "one text that very many documents without links are said to share here"
    rows = pa.RecordBatch.from_arrays([pa.array(range(3000), pa.int64()), pa.array([text] * 3000), pa.array(range(3000), pa.int64())], ["node", "text", "component"])
    blocks = pa.Table.from_batches(list(jaccard._entry_blocks(1, NONE)([rows])))
    out = jaccard._torn(blocks)
    assert set(out.column("lead").to_pylist()) == {0}
    assert sum(len(jaccard.zlib.decompress(x.as_py())) // 8 for x in blocks.column("sig")) == len(out)


@pytest.mark.parametrize("most", [0, 10**6])
def test_hidden_links_are_found(spark, monkeypatch, most):
    """Equal to all pairs, with the joins shipped (many rows allowed) and dealt to salts (none allowed)."""
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", most)
    monkeypatch.setattr(jaccard, "TILE", 8)
    called = []
    plain = jaccard.hidden_pairs
    monkeypatch.setattr(jaccard, "hidden_pairs", lambda *args: called.append(1) or plain(*args))
    texts = variants(random.Random(8), 3, 25, 5)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(frame).collect()}
    assert [found[i] for i in range(len(texts))] == components(texts)
    assert called
