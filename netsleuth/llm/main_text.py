"""The article of a web page: flat text blocks, each kept or dropped by a decision tree.

A block's features are its words and link density, those of the blocks before and after
it, and what its surroundings say (``html_blocks.FEATURES``). The tree is learned from a
small labelled table: the blocks of the pages in ``page_samples``. It is learned on the
driver in milliseconds and goes to the tasks as a few arrays; every page is read by
itself in ``mapInArrow``, without a shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsleuth.llm.html_blocks import features, text_blocks
from netsleuth.llm.page_samples import labelled_blocks
from netsleuth.llm.shared import ship

DEPTH, LEAF = 10, 2

SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


class Tree:
    """A binary tree as arrays: feature (-1 at a leaf), threshold, the two children and the share of kept rows."""

    def __init__(self, feature, threshold, left, right, share):
        self.feature, self.threshold, self.left, self.right, self.share = feature, threshold, left, right, share

    def share_of(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), dtype=np.int64)
        while True:
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return self.share[at]
            low = rows[inner, feature[inner]] <= self.threshold[at[inner]]
            at[inner] = np.where(low, self.left[at[inner]], self.right[at[inner]])


def _best_split(rows: np.ndarray, kept: np.ndarray):
    """(gain, feature, threshold) of the split with the purest halves; ties go to the first feature."""
    n, total = len(rows), kept.sum()
    impurity = lambda k, m: k * (m - k) / np.maximum(m, 1)
    best = (0.0, -1, 0.0)
    for feature in range(rows.shape[1]):
        order = np.argsort(rows[:, feature], kind="stable")
        value, ones = rows[order, feature], np.cumsum(kept[order])[:-1]
        size = np.arange(1, n)
        cut = (value[1:] > value[:-1]) & (size >= LEAF) & (n - size >= LEAF)
        if not cut.any():
            continue
        gain = impurity(total, n) - impurity(ones, size) - impurity(total - ones, n - size)
        k = int(np.argmax(np.where(cut, gain, -1)))
        if gain[k] > best[0] + 1e-12:
            best = (float(gain[k]), feature, float(value[k] + value[k + 1]) / 2)
    return best


def fit_tree(rows: np.ndarray, kept: np.ndarray, depth: int = DEPTH) -> Tree:
    """A tree grown by Gini impurity."""
    nodes: list[list] = []

    def grow(index, level):
        node = len(nodes)
        nodes.append([-1, 0.0, -1, -1, float(kept[index].mean()) if len(index) else 0.0])
        if level and 0 < nodes[node][4] < 1:
            gain, feature, threshold = _best_split(rows[index], kept[index])
            if feature >= 0:
                low = rows[index, feature] <= threshold
                nodes[node][:4] = [feature, threshold, grow(index[low], level - 1), grow(index[~low], level - 1)]
        return node

    grow(np.arange(len(rows)), depth)
    columns = list(zip(*nodes))
    return Tree(*(np.array(c) for c in columns))


def train_tree() -> Tree:
    """The tree of the labelled table."""
    rows, kept = labelled_blocks()
    return fit_tree(np.array(rows, dtype=float), np.array(kept, dtype=float))


def main_text(page: str | None, tree: Tree) -> str:
    """The kept blocks of one page, an empty line between them; empty if there is none."""
    blocks = text_blocks(page)
    if not blocks:
        return ""
    share = tree.share_of(np.array(features(blocks), dtype=float))
    return "\n\n".join(b.text for b, s in zip(blocks, share.tolist()) if s >= 0.5)


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row, with or without an id or url.

    ``text`` is the main text, ``n_chars`` its code points. A null or empty html, and a
    page without an article, give an empty text. Repeated rows give repeated results;
    other columns are ignored.
    """
    import pyarrow as pa

    ship(pages.sparkSession)
    tree = tree or train_tree()

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                some = batch.slice(a, 64)
                found = [main_text(h, tree) for h in some.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("page_id"), some.column("url"), pa.array(found, pa.string()),
                     pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, SCHEMA)
