"""Token counts by greedy longest match in linear time.

A text's tokens are counted without building pieces. Words ``[^\\x20\\x09-\\x0D]+``, each with one space before it, are
read byte by byte through a trie of the vocabulary. Where the trie has no child, the failure link of the node leads to
the node for what is left after the longest matches so far, and a count stored with the link says how many tokens
that popped. Both are computed once, in order of depth, so each byte costs a constant number of steps.

The vocabulary must hold every single byte, as byte-level vocabularies do. Workers keep the automaton, and the counts
of up to ``REMEMBERED`` words.

Defined cases: a null, empty or blank text has 0 tokens; repeated rows are counted one by one; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merkato.llm.common import ship, worker_memory

VOCABULARY = "byte_bpe_50k.tiktoken"
REMEMBERED = 1_000_000


def read_vocabulary(file: str) -> list[bytes]:
    with open(file, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class LongestMatch:
    """Trie with failure links and popped-token counts."""

    def __init__(self, vocabulary: list[bytes]):
        self.children: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in vocabulary:
            node = 0
            for byte in piece:
                following = self.children[node].get(byte)
                if following is None:
                    following = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    whole.append(False)
                node = following
            whole[node] = True
        if not all(whole[self.children[0].get(b, 0)] for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.link, self.popped = [0] * len(whole), [0] * len(whole)
        level = [0]
        while level:
            deeper = []
            for node in level:
                for byte, child in self.children[node].items():
                    deeper.append(child)
                    if whole[child]:  # the longest match is the whole of it
                        self.popped[child] = 1
                        continue
                    at, count = self.link[node], self.popped[node]
                    while byte not in self.children[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    self.link[child], self.popped[child] = self.children[at][byte], count
            level = deeper

    def count(self, word: bytes) -> int:
        children, link, popped = self.children, self.link, self.popped
        node = tokens = 0
        for byte in word:
            while byte not in children[node]:
                tokens += popped[node]
                node = link[node]
            node = children[node][byte]
        while node:
            tokens += popped[node]
            node = link[node]
        return tokens


def count_tokens(docs: DataFrame, vocabulary: str | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """One row per document: ``(doc_id, n_words, n_tokens)``.

    ``vocabulary`` is the vocabulary's file; unset, it is found on each worker in the public vocabularies.
    """
    def run(batches):
        memory, key = worker_memory(), ("longest match", vocabulary)
        if key not in memory:
            import public_tokenizers

            memory[key] = (LongestMatch(read_vocabulary(vocabulary or public_tokenizers.path(VOCABULARY))), {})
        automaton, known = memory[key]
        for batch in batches:
            words_of, tokens_of = [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                if len(known) > remembered:
                    known.clear()
                for word in set(words).difference(known):
                    known[word] = automaton.count(b" " + word)
                words_of.append(len(words))
                tokens_of.append(sum(map(known.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words_of, pa.int64()), pa.array(tokens_of, pa.int64())],
                names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long")


ship(__name__)
