"""Time-forward processing: totals travel from nodes to their parents through a queue.

Nodes arrive in reverse level order, the deepest level first, and each level in the
order of its keys. A node takes the messages that its children have left in the queue,
adds them to its own values and leaves a message for its parent. Because the queue is
ordered as the nodes are, nothing is ever looked up.
"""

import heapq
import pickle
import tempfile

IN_MEMORY = 1 << 18


class SpillingQueue:
    """A priority queue of tuples that keeps at most `limit` of them in memory.

    What is beyond goes as a sorted run to an unnamed file of the task's own, which ends
    with the task, as Spark's sorts do; every run is read back in small pieces.
    """

    def __init__(self, limit=IN_MEMORY):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, item):
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self):
        file = tempfile.TemporaryFile()
        self.heap.sort()
        for first in range(0, len(self.heap), 1024):
            pickle.dump(self.heap[first : first + 1024], file)
        size, self.heap = file.tell(), []
        file.seek(0)
        run = self._read(file, size)
        # The runs are a queue themselves, ordered by what comes next in each.
        heapq.heappush(self.runs, (next(run), len(self.runs), id(run), run))

    @staticmethod
    def _read(file, size):
        with file:
            while file.tell() < size:
                yield from pickle.load(file)

    def least(self):
        """The first item, or None."""
        own = self.heap[0] if self.heap else None
        spilled = self.runs[0][0] if self.runs else None
        if own is None or spilled is None:
            return spilled if own is None else own
        return min(own, spilled)

    def pop(self):
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, number, name, run = self.runs[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, name, run))
            return item
        return heapq.heappop(self.heap)


class Totals:
    """Takes nodes, sorted by shard and key, and says each one's totals over its subtree.

    A key orders deeper nodes first. What the topmost nodes of a shard leave for their
    parents is for the caller to pass on.
    """

    def __init__(self, limit=IN_MEMORY):
        self.limit, self.shard, self.queue = limit, None, None

    def node(self, shard, key, parent, children, leaves, saved):
        """(children, leaves, saved) of a node's subtree.

        The last three arguments are the node's own saving and what has come from outside
        of the shard. A node without children is a leaf; `parent` is None at the root.
        """
        if self.queue is None or shard != self.shard:
            self.shard, self.queue = shard, SpillingQueue(self.limit)
        queue = self.queue
        while (message := queue.least()) is not None and message[0] <= key:
            to, more_leaves, more_saved = queue.pop()
            if to == key:
                children += 1
                leaves += more_leaves
                saved += more_saved
        leaves = leaves if children else 1
        if parent is not None:
            queue.push((parent, leaves, saved))
        return children, leaves, saved
