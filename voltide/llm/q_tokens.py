"""Queries of the tokenizer operators. SQL cannot express them; tests compare them
with the tokenizers library run on each text."""

from __future__ import annotations

import public_tokenizers

from voltide.llm.catalog import query
from voltide.llm.common import scratch_path, table
from voltide.llm.packing import pack_documents
from voltide.llm.token_files import read_tokens, write_tokens
from voltide.llm.tree_bpe import digest_documents

BYTE_FILE = "byte_bpe_50k.json"
WORD_FILE = "word_bpe_49k.json"


@query("op6_best_fit_packing")
def best_fit_packing(spark, sf):
    return pack_documents(table(spark, sf, "documents"), public_tokenizers.path(BYTE_FILE), ids=False)


@query("op7_tree_bpe")
def tree_bpe(spark, sf):
    return digest_documents(table(spark, sf, "documents"), public_tokenizers.path(BYTE_FILE))


@query("op9_token_files")
def token_files(spark, sf):
    folder = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf, "documents"), public_tokenizers.path(WORD_FILE), folder)
    return read_tokens(spark, folder, ids=False)
