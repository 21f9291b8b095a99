"""Epochs of a mix as permutations of blocks and rows."""

from collections import defaultdict

from inkveil.llm import mixing


def sequences(rows):
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.block_order, r.block, r.row_order)):
        found[r.source, r.epoch].append((r.doc_id, r.block))
    return found


def test_epochs_are_permutations_of_blocks(spark):
    rows = [(k, "w " * (1 + k % 7), "ab"[k % 3 > 0]) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    part = sequences(mixing.report(docs, budget=4_000).collect())
    whole = sequences(mixing.report(docs, budget=12_000).collect())
    cut = 0
    for (source, epoch), own in part.items():
        # an epoch is the beginning of the same permutation, whatever the budget
        assert own == whole[source, epoch][: len(own)]
        cut += len(own) < len(whole[source, epoch])
    assert cut
    for (source, epoch), own in whole.items():
        blocks = [b for _, b in own]
        turns = sum(x != y for x, y in zip(blocks, blocks[1:], strict=False)) + 1
        assert turns == len(set(blocks))  # blocks stay together
        if epoch and len(own) == len(whole[source, 0]):
            assert own != whole[source, 0] and sorted(own) == sorted(whole[source, 0])


def test_names_of_places_may_be_taken(edge):
    got = mixing.mixed(edge, epoch="epoch", block="place", block_order="mix_full", row_order="fp")
    assert set(got.columns) == set(edge.columns)
    assert got.count() == mixing.mixed(edge).count()
    assert got.filter("mix_full IS NULL OR fp IS NULL OR epoch IS NULL OR place IS NULL").count() == 0
