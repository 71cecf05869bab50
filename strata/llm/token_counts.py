"""Token counts by trie-shared dynamic programming (operator 8).

Each task walks the trie of the distinct pre-tokens that it meets: forward scores are
computed once per shared prefix, and the count at the end of a pre-token is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm._util import id_type, slices, strings
from strata.llm.lattice import MARK, Vocabulary, Walk, marked_words

ROWS = 4096           # texts whose new pre-tokens are walked together
STORED = 600_000      # terminal counts that a task keeps
_LONG = 64            # longer pre-tokens are not kept


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, stored = Vocabulary(path), {}
        for batch in slices(batches, ROWS):
            texts = [marked_words(t) for t in strings(batch.column("text"))]
            if len(stored) > STORED:
                stored.clear()
            new = {w for words in texts for w in words if w not in stored}
            stored.update((w[1:], n) for w, n in Walk(vocabulary).counts(MARK + w for w in new))
            tokens = [sum(map(stored.__getitem__, words)) for words in texts]
            for w in new:
                if len(w) > _LONG:
                    del stored[w]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_pretokens, n_tokens.

    ``model`` is the path of a SentencePiece file, on every executor; its pieces and
    scores are read as a unigram model, and n_tokens is the length of the likeliest
    segmentation (ties: the longer last piece), bytes of uncovered characters included.
    A null or empty text has no tokens. Ids may be null and rows may repeat; an empty
    table gives an empty result.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_counted(model), f"doc_id {id_type(docs, id_col)}, n_pretokens long, n_tokens long")
