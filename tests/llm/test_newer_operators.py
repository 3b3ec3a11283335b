"""Filter audit, MinHash components and token alignment, against plain Python."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from sentencepiece import SentencePieceProcessor  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from cobasket.llm import alignment, filter_audit, minhash  # noqa: E402
from cobasket.llm.oracles import ORACLES  # noqa: E402
from cobasket.llm.queries import QUERIES  # noqa: E402
from odd_rows import DOCUMENTS, document_rows  # noqa: E402

DOCS = document_rows()
BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, texts):
    rows = [(i, x, "en", "src", 0) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


# ---------------------------------------------------------------- filter audit


def fails(row):
    text = row[1] or ""
    words = re.findall(WORD, text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": row[0] is not None and any(o[0] is not None and o[0] < row[0] and (o[1] or "") == text for o in DOCS),
    }


def test_op11_equals_step_by_step_filtering(spark, odd_tables):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{odd_tables}/labels.parquet").collect() if r["doc_id"] is not None}
    labelled = lambda key, name: int(key in labels and labels[key][name] == 1)
    rows = [(r[3] or "", fails(r), labelled(r[0], "quality"), labelled(r[0], "toxic")) for r in DOCS]
    expected, total = {}, collections.Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                failing = [r for r in mine if r[1][letter]]
                removed = [r for r in left if r[1][letter]]
                left = [r for r in left if not r[1][letter]]
                only = sum(sum(r[1].values()) == 1 for r in failing)
                lost = [sum(r[i] for r in removed) for i in (2, 3)]
                expected[part, order, step] = [len(left), len(removed), len(failing) - len(removed), only, *lost]
                total[part, letter] += len(removed)
    found = {
        (r["part"], r["filter_order"], r["step"]): [r[n] for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
        for r in QUERIES["op11_filter_audit"](spark, odd_tables).collect()
    }
    assert found == {k: [*v, total[k[0], k[1][k[2] - 1]]] for k, v in expected.items()}


def test_op11_equals_its_sql_on_odd_tables(spark, odd_tables):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in ("documents", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{odd_tables}/{name}.parquet/*.parquet'")
    expected = connection.execute(ORACLES["op11_filter_audit"])
    columns = [c[0] for c in expected.description]
    found = QUERIES["op11_filter_audit"](spark, odd_tables)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == sorted(expected.fetchall())


@pytest.mark.parametrize("filters", [1, 2, 4])
def test_steps_are_the_first_failing_filter(filters):
    orders = filter_audit.orders_of(filters)
    steps = filter_audit.removal_steps(orders)
    for mask in range(1 << filters):
        for number, order in enumerate(orders.tolist()):
            assert steps[mask, number] == next((i for i, f in enumerate(order) if mask >> f & 1), filters)


def test_scatter_adds_weights_of_masks():
    steps = filter_audit.removal_steps(filter_audit.orders_of(2))
    assert filter_audit.scatter(steps, np.array([5, 1, 2, 4])).tolist() == [[5, 2, 5], [6, 1, 5]]


def test_any_filters_and_losses(spark):
    rows = spark.createDataFrame([("p", 1, 1), ("p", 3, 0), ("p", None, 1), (None, 2, None)], "source string, failed int, w int")
    found = {(r["source"], r["filter_order"], r["step"]): r for r in filter_audit.audit(rows, "XY", "failed", "source", ["w"]).collect()}
    assert len(found) == 8
    assert [found["p", "XY", 1][n] for n in ("kept", "removed", "w_lost", "shapley")] == [1, 2, 1, 3]
    assert [found["p", "XY", 2][n] for n in ("kept", "removed", "redundant", "unique_fails")] == [1, 0, 1, 0]
    assert [found[None, "YX", 1][n] for n in ("removed", "w_lost", "unique_fails")] == [1, 0, 1]


# ---------------------------------------------------------------- MinHash components


def shingles(text, words=4):
    found = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def expected_components(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
            shared = len(a & b)
            if 100 * shared >= 80 * (len(a) + len(b) - shared):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    names = [least.get(find(i)) if s else r[0] for i, (r, s) in enumerate(zip(rows, sets, strict=True))]
    return collections.Counter((r[0], len(s), n, n is not None and n == r[0]) for r, s, n in zip(rows, sets, names, strict=True))


def components_of(frame, **options):
    return collections.Counter(tuple(r) for r in minhash.near_duplicates(frame, **options).collect())


def test_op12_equals_brute_force(spark, odd_tables):
    found = collections.Counter(tuple(r) for r in QUERIES["op12_minhash_components"](spark, odd_tables).collect())
    assert found == expected_components(DOCS)


def test_links_around_the_threshold(spark):
    """Pairs of every similarity from 0.6 to 1, none of which has anything else to hold on to."""
    draw, texts = random.Random(12), []
    for changed in range(60):
        words = [f"w{draw.randrange(10**9)}" for _ in range(200)]
        texts.append(" ".join(words))
        for i in draw.sample(range(200), changed // 4):
            words[i] = f"x{draw.randrange(10**9)}"
        texts.append(" ".join(words))
    rows = [(i, x) for i, x in enumerate(texts)]
    expected = expected_components(rows)
    assert 60 < sum(kept for *_, kept in expected.elements()) < 110
    assert components_of(table(spark, texts)) == expected


def test_chains_and_neighbours_that_fail(spark):
    """Texts that only hang together through others, beside texts that share half with all of them."""
    draw = random.Random(3)
    common = [f"c{i}" for i in range(60)]
    chain = [f"a{i}" for i in range(400)]
    texts = [" ".join(common + [f"u{draw.randrange(10**9)}" for _ in range(45)]) for _ in range(30)]
    texts += [" ".join(common + chain[i * 4 : i * 4 + 200]) for i in range(40)]
    draw.shuffle(texts)
    assert components_of(table(spark, texts)) == expected_components([(i, x) for i, x in enumerate(texts)])


def test_clusters_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash.links_between_groups, "__defaults__", (400,))
    test_chains_and_neighbours_that_fail(spark)


def test_search_joins_what_is_similar_and_rejects_the_rest():
    sets = [np.arange(i, i + 100) for i in (0, 5, 10, 500, 505, 30)]
    nodes, whole = np.arange(6), np.zeros(6, dtype=int)
    joined = {frozenset(x) for x in minhash.search(sets, nodes, nodes, whole, 80)}
    assert joined == {frozenset(x) for x in ((0, 1), (0, 2), (3, 4))}
    assert minhash.search(sets, nodes, np.array([0, 0, 0, 3, 3, 5]), whole, 80) == []
    blocks = np.array([0, 0, 1, 1, 1, 0])
    across = {frozenset(x) for x in minhash.search(sets, nodes, nodes, blocks, 80)}
    assert across == {frozenset((0, 2)), frozenset((1, 2))}


def test_work_grows_with_a_group_not_its_square(spark):
    """Near copies of one text: a link each, and as many table entries and links per text at any size."""
    draw = random.Random(5)
    base = [f"b{i}" for i in range(220)]
    per_text = []
    for size in (250, 1000):
        texts = []
        for _ in range(size):
            words = list(base)
            for i in draw.sample(range(220), 3):
                words[i] = f"x{draw.randrange(10**9)}"
            texts.append(" ".join(words))
        row = minhash.F.xxhash64("doc_id")
        made = minhash.written(minhash.signatures(table(spark, texts), "doc_id", "text", row, 4), "signatures")
        members = minhash.written(minhash.table_members(made.select("node", "bands")), "members")
        contents = minhash.candidate_texts(table(spark, texts), made, minhash.neighbours(members), "text", row)
        close = minhash.links_to_neighbours(minhash.written(contents, "contents"), 4, 80).count()
        per_text.append((members.count() / size, close / size))
    (entries, close), (more_entries, more_close) = per_text
    assert more_close < 1.1 and close < 1.1
    assert more_entries <= minhash.GROUPS**2 and more_entries < 1.5 * entries


# ---------------------------------------------------------------- token alignment


def libraries():
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=PIECE_BPE)


@pytest.fixture(scope="module")
def both():
    return libraries()


def token_bytes(both, text):
    """Both sides' (id, bytes), as the libraries cut the whole text."""
    a, b = both
    symbols = alignment.byte_symbols()
    encoded = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(symbols[c] for c in t)) for i, t in zip(encoded.ids, encoded.tokens, strict=True)]
    right = []
    for i in b.encode(text):
        name = b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", name)
        right.append((i, bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if not text or b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return [], []
    return left, right


def aligned(both, text):
    """Groups as text, and all links, by walking through the bytes."""
    left, right = token_bytes(both, text)
    owner = [[], []]
    for side, tokens in zip(owner, (left, right), strict=True):
        for number, (_, content) in enumerate(tokens):
            side += [number] * len(content)
    links = {(i, j) for i, j in zip(*owner, strict=True)}
    groups, at = [], (0, 0)
    for k in range(len(owner[0])):
        last = k + 1 == len(owner[0])
        if last or (owner[0][k + 1] != owner[0][k] and owner[1][k + 1] != owner[1][k]):
            to = owner[0][k] + 1, owner[1][k] + 1
            ids = [",".join(str(t[0]) for t in side[b:e]) for side, b, e in zip((left, right), at, to, strict=True)]
            groups.append("|".join(ids))
            at = to
    return left, right, ";".join(groups), [(left[i][0], right[j][0]) for i, j in links]


def expected_alignment(both, rows):
    found = [aligned(both, r[1] or "") for r in rows]
    count = collections.Counter(p for *_, links in found for p in set(links))
    most = collections.defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = collections.Counter()
    for row, (left, right, groups, links) in zip(rows, found, strict=True):
        best = sum(count[p] == most[p[0]] for p in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out[row[0], len(left), len(right), groups.count("|"), len(links), best, sum(count[p] for p in links), digest] += 1
    return out


def test_op13_equals_walking_through_the_bytes(spark, odd_tables, both):
    found = collections.Counter(tuple(r) for r in QUERIES["op13_token_alignment"](spark, odd_tables).collect())
    assert found == expected_alignment(both, DOCS)


def test_small_batches_count_the_same(spark, both, monkeypatch):
    rows = [r for r in DOCS if len(r[1] or "") < 2_000]
    monkeypatch.setattr(alignment, "ENTRIES", 500)
    monkeypatch.setattr(alignment, "HELD_CHARS", 2_000)
    frame = spark.createDataFrame(rows, DOCUMENTS).coalesce(1)
    table_ = alignment.measured(frame, BYTE_BPE, PIECE_BPE, "doc_id", "text", True).collect()
    size_b, base = len(alignment.tokenizer(PIECE_BPE).bytes_of), collections.Counter()
    for row in table_:
        if row["slot"] is not None:
            base[row["pair"]] += row["documents"]
    expected = collections.Counter(a * size_b + b for r in rows for a, b in set(aligned(both, r[1] or "")[3]))
    assert base == expected
    assert sorted(r["groups"] for r in table_ if r["slot"] is None) == sorted(aligned(both, r[1] or "")[2] for r in rows)


class TestAlignment:
    parts = st.sampled_from(["the", " of", "  ", " ", "\n", "\n\n", "\t", "Straße", "漢字", "é", "<s>", "</s>", "<|endoftext|>", "▁", "▁▁", "12", "x" * 40, "\x1c", "\x85", "\xa0", "　", "\U0001f600", "\0", "'s", "…", "<0x41>", " ́"])

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.one_of(st.lists(parts, max_size=20).map("".join), st.text(st.characters(codec="utf-8"), max_size=40)), min_size=1, max_size=4))
    def test_any_texts_as_the_libraries(self, both, texts):
        store = alignment.Chunks(BYTE_BPE, PIECE_BPE)
        good, ((a, n_a), (b, n_b)) = store.encode(texts)
        at_a = at_b = 0
        for text, fine, m, n in zip(texts, good, n_a, n_b, strict=True):
            left, right = token_bytes(both, text)
            assert fine == bool(left)
            assert [i for i, _ in left] == a[at_a : at_a + m].tolist() and [i for i, _ in right] == b[at_b : at_b + n].tolist()
            at_a, at_b = at_a + m, at_b + n

    @settings(max_examples=200, deadline=None)
    @given(st.integers(1, 60).flatmap(lambda n: st.tuples(st.sets(st.integers(1, n)), st.sets(st.integers(1, n)), st.just(n))))
    def test_pointer_jumping_cuts_at_common_ends(self, ends):
        end_a, end_b = (np.array(sorted(e | {ends[2]})) for e in ends[:2])
        cuts = sorted(set(end_a.tolist()) & set(end_b.tolist()))
        for end, group in zip((end_a, end_b), alignment.groups_of(end_a, end_b), strict=True):
            assert group.tolist() == np.searchsorted(cuts, end).tolist()
        start_a, start_b = (np.r_[0, e[:-1]] for e in (end_a, end_b))
        expected = {(i, j) for i in range(len(end_a)) for j in range(len(end_b)) if start_a[i] < end_b[j] and start_b[j] < end_a[i]}
        assert set(zip(*(x.tolist() for x in alignment.links_of(end_a, end_b)), strict=True)) == expected

    def test_no_piece_goes_across_a_blank_after_a_word(self):
        assert not [n for n in alignment.tokenizer(PIECE_BPE).bytes_of if re.search(rb"[^ ] ", n)]

    def test_groups_in_full(self, spark, both):
        frame = table(spark, ["unbelievable nonsense", "", None, "Straße"])
        found = {r["doc_id"]: r["groups"] for r in alignment.align(frame, BYTE_BPE, PIECE_BPE, with_groups=True).collect()}
        assert found == {0: aligned(both, "unbelievable nonsense")[2], 1: "", 2: "", 3: aligned(both, "Straße")[2]}
