"""Words of many texts at once, on Arrow arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~…–—«»“”‘’¿¡"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between ASCII white space, all in a row, and for each text the
    place of its first word (plus the end). Null texts have no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    words, edges = lists.flatten(), lists.offsets.to_numpy()
    edges = edges - edges[0]
    filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    if not filled.all():
        edges = np.concatenate(([0], np.cumsum(filled)))[edges]
        words = words.filter(pa.array(filled))
    return words, edges


def bare_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, number of each word in the row, place of each text's first).

    Words are in lower case and without outer punctuation; what is nothing but
    punctuation is left out.
    """
    words, edges = split_words(texts)
    coded = words.dictionary_encode()
    bare = pc.utf8_trim(pc.utf8_lower(coded.dictionary), PUNCTUATION).dictionary_encode()
    codes = bare.indices.to_numpy()[coded.indices.to_numpy()] if len(words) else np.zeros(0, int)
    empty = pc.index(bare.dictionary, pa.scalar("", bare.dictionary.type)).as_py()
    if empty >= 0:
        filled = codes != empty
        edges = np.concatenate(([0], np.cumsum(filled)))[edges]
        codes = codes[filled]
    return bare.dictionary, codes, edges
