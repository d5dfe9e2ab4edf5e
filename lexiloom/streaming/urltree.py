"""Boilerplate by address trees with state per domain, bounded by age and size, as a streaming operator.

Of every domain the state holds, for each node of the tree of reversed host labels and path segments, how many documents lie at or below it
and in how many of them each block occurs, the revisions of every address, and the documents in order of arrival. The oldest leave it
beyond `days` behind the newest time of the batch while more than `least` remain, and whenever there are more than `most`. A group's rows
come in Arrow batches and are never held together.
"""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DAY = 86_400_000_000
#: Elements whose blocks are never content.
SKIP = frozenset("nav footer aside header form select".split())


def nodes_of(url: str, domain: str) -> list[str]:
    """The nodes of an address from the domain's root down: further host labels in reverse, then path segments but the last (kept with a query)."""
    rest = url.split("://", 1)[-1]
    host, _, path = rest.partition("/")
    host = host.split(":")[0].lower()
    extra = host[: -len(domain)].rstrip(".").split(".") if host.endswith(domain) and host != domain else []
    path, q, _ = path.partition("?")
    segs = [s for s in path.split("/") if s]
    segs = segs if q else segs[:-1]
    out = ["/"]
    for s in [*(f"@{x}" for x in reversed(extra) if x), *segs]:
        out.append(out[-1] + s + "/")
    return out


class UrlTree:
    """The state of one domain."""

    def __init__(self, least: int = 100, most: int = 10_000, days: int = 14, voters: int = 5, per: int = 100, tie: bool = True):
        self.least, self.most, self.days, self.voters, self.per, self.tie = least, most, days, voters, per, tie
        self.docs: dict[str, int] = {}
        self.blocks: dict[tuple[str, int], int] = {}
        self.revs: dict[str, int] = {}
        self.queue: deque = deque()

    def insert(self, time: int, url: str, nodes: list[str], hashes: set[int], count: bool) -> None:
        for n in nodes:
            if count:
                self.docs[n] = self.docs.get(n, 0) + 1
            for h in hashes:
                self.blocks[n, h] = self.blocks.get((n, h), 0) + 1
        self.queue.append((time, url, nodes, hashes, count))

    def evict(self, newest: int) -> None:
        while self.queue and (len(self.queue) > self.most or (len(self.queue) > self.least and self.queue[0][0] < newest - self.days * DAY)):
            _, url, nodes, hashes, count = self.queue.popleft()
            if count:
                self.revs.pop(url, None)
            for n in nodes:
                if count:
                    self.docs[n] -= 1
                    if not self.docs[n]:
                        del self.docs[n]
                for h in hashes:
                    self.blocks[n, h] -= 1
                    if not self.blocks[n, h]:
                        del self.blocks[n, h]

    def boilerplate(self, nodes: list[str], h: int) -> bool:
        """The vote of the nodes from the leaf to the root that have enough documents; the root alone if none has."""
        v = [n for n in nodes if self.docs.get(n, 0) >= self.voters] or nodes[:1]
        yes = sum(self.blocks.get((n, h), 0) > self.docs.get(n, 0) // self.per + 1 for n in v)
        return yes * 2 > len(v) or (self.tie and yes * 2 == len(v))

    def batch(self, rows: list[tuple], domain: str) -> list[tuple]:
        """rows: docid, time (us), url, hashes, chars, link_shares, paths. Result: docid, rev, block_no, kind, after all rows are in."""
        todo = []
        for docid, time, url, hashes, chars, shares, paths in rows:
            rev = self.revs[url] = self.revs.get(url, 0) + 1
            nodes = nodes_of(url, domain)
            if rev == 1:
                self.insert(time, url, nodes, set(hashes), True)
            todo.append((docid, time, url, rev, nodes, hashes, chars, shares, paths))
        out = []
        for docid, time, url, rev, nodes, hashes, chars, shares, paths in todo:
            deep = next((n for n in reversed(nodes) if self.docs.get(n, 0) >= self.voters), nodes[0])
            new, n_new = set(), 0
            for i, h in enumerate(hashes):
                if self.boilerplate(nodes, h) or (shares[i] or 0) >= 1.0 or SKIP.intersection((paths[i] or "").split("/")):
                    kind = "TextBlock/Boilerplate"
                elif not self.blocks.get((deep, h)):
                    kind = "TextBlock/Content/Unseen"
                    new.add(h)
                    n_new += chars[i] or 0
                else:
                    kind = "TextBlock/Content"
                out.append((docid, rev, i, kind))
            if rev > 1 and n_new > 99:
                self.insert(time, url, nodes, new, False)
        self.evict(max((r[1] for r in rows), default=0))
        return out


OUT = "docid long, rev int, block_no int, kind string"
COLUMNS = ("docid", "time", "url", "hashes", "chars", "link_shares", "paths")


def label_stream(stream: DataFrame, domain: str = "domain", **limits: int) -> DataFrame:
    """docid, rev, block_no, kind of a stream of documents (docid, time in us, url, hashes, chars, link_shares, paths and the domain)."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tree = pickle.loads(state.get[0]) if state.exists else UrlTree(**limits)
        for b in batches:
            b = b.sort_values(["time", "docid"])
            rows = [tuple(list(v) if hasattr(v, "__len__") and not isinstance(v, str) else v for v in r) for r in b[list(COLUMNS)].itertuples(index=False)]
            yield pd.DataFrame(tree.batch(rows, key[0]), columns=["docid", "rev", "block_no", "kind"])
        state.update((pickle.dumps(tree),))

    return stream.select(domain, *COLUMNS).groupBy(domain).applyInPandasWithState(run, OUT, "tree binary", "append", GroupStateTimeout.NoTimeout)


def first_seen_bounded(stream: DataFrame, key: str, group: str, row: str, most: int = 30_000) -> DataFrame:
    """group, row, key of rows whose key is not among the last `most` keys of their group; the history is a queue in arrival order (by row)."""
    kinds = dict(stream.dtypes)

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        queue = deque(pickle.loads(state.get[0]) if state.exists else ())
        seen = set(queue)
        for b in batches:
            b = b.sort_values(row)
            keep = []
            for v in b[key]:
                keep.append(v not in seen)
                if keep[-1]:
                    seen.add(v)
                    queue.append(v)
                    if len(queue) > most:
                        seen.discard(queue.popleft())
            yield b.loc[keep, [group, row, key]]
        state.update((pickle.dumps(list(queue)),))

    out = f"{group} {kinds[group]}, {row} {kinds[row]}, {key} {kinds[key]}"
    return stream.select(group, row, key).groupBy(group).applyInPandasWithState(run, out, "seen binary", "append", GroupStateTimeout.NoTimeout)


def kept_and_dumped(batch: DataFrame, keep, kept_sink, dump_sink) -> None:
    """Splits one batch: rows that pass go to one sink, the others to the second; a null predicate keeps; empty parts are not forwarded."""
    from pyspark.sql import functions as F

    flag = batch.withColumn("_kept", F.coalesce(keep, F.lit(True))).persist()
    try:
        for part, sink in ((flag.where("_kept"), kept_sink), (flag.where("not _kept"), dump_sink)):
            part = part.drop("_kept")
            if sink is not None and not part.isEmpty():
                sink(part)
    finally:
        flag.unpersist()
