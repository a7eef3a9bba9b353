"""The registered queries of the corpus operators. SQL can express two of them; tests/llm holds the others against brute force."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bagminhash import op10_bagminhash
from .blocknames import op12_block_names
from .bpe import op9_byte_bpe
from .embeddings import op4_embeddings
from .langid import op3_langid
from .matroska import op5_matroska
from .packing import op2_packing
from .substrings import op8_run_length_index
from .token_files import op1_token_files
from .toxicity import op6_toxicity
from .whitening import op11_whitening
from .wrappers import op7_wrappers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_packing": op2_packing,
    "op3_langid": op3_langid,
    "op4_embeddings": op4_embeddings,
    "op5_matroska": op5_matroska,
    "op6_toxicity": op6_toxicity,
    "op7_wrappers": op7_wrappers,
    "op8_run_length_index": op8_run_length_index,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_bagminhash": op10_bagminhash,
    "op11_whitening": op11_whitening,
    "op12_block_names": op12_block_names,
}

ORACLE_SQL: dict[str, str] = {
    "op4_embeddings": """
        with recursive v as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) e from embeddings),
        n as (select vec_id, label, e, sqrt(list_dot_product(e, e)) s from v),
        links as (select a.vec_id a, b.vec_id b from n a join n b on a.label = b.label and a.vec_id <> b.vec_id where list_dot_product(a.e, b.e) / (a.s * b.s) >= 0.98),
        reach(vec_id, other) as (select vec_id, vec_id from embeddings union select links.b, reach.other from reach join links on links.a = reach.vec_id),
        least as (select vec_id, min(other) component_id from reach group by vec_id)
        select vec_id, (select count(*) from links where a = least.vec_id) n_links, component_id, vec_id = component_id kept from least""",
    "op12_block_names": r"""
        with t as (select doc_id, length(coalesce(text, '')) chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') plain from documents),
        g as (select *, first_value(doc_id) over w keep_id, count(*) over (partition by plain) group_size from t window w as (partition by plain order by chars desc, doc_id))
        select doc_id, keep_id, group_size, doc_id = keep_id kept, sha256(plain) text_sha256 from g""",
}
