"""The registered queries of this subpackage."""

from __future__ import annotations

from types import SimpleNamespace

from kontor.llm.bpe import op9_bpe
from kontor.llm.collocations import OP13_SQL, op13_collocations
from kontor.llm.decontamination import OP12_SQL, op12_decontamination
from kontor.llm.fill_in_middle import OP11_SQL, op11_fill_in_middle
from kontor.llm.graph_search import op10_graph
from kontor.llm.hamming import OP7_SQL, op7_hamming
from kontor.llm.language import op3_language
from kontor.llm.minhash import op2_minhash
from kontor.llm.packing import op4_packing
from kontor.llm.quality import op6_quality
from kontor.llm.secrets import op8_secrets
from kontor.llm.suffix_dedup import op1_suffix_dedup
from kontor.llm.warc import op5_warc

QUERIES = {
    query.__name__: query
    for query in (
        op1_suffix_dedup,
        op2_minhash,
        op3_language,
        op4_packing,
        op5_warc,
        op6_quality,
        op7_hamming,
        op8_secrets,
        op9_bpe,
        op10_graph,
        op11_fill_in_middle,
        op12_decontamination,
        op13_collocations,
    )
}
SQL: dict[str, str] = {
    "op7_hamming": OP7_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_decontamination": OP12_SQL,
    "op13_collocations": OP13_SQL,
}


def with_pipeline(pipeline) -> SimpleNamespace:
    """Queries and their SQL, with the pipeline of stages."""
    sql = {"pipeline": pipeline.ORACLE_SQL} if pipeline.ORACLE_SQL else {}
    return SimpleNamespace(queries={**QUERIES, "pipeline": pipeline.run}, sql={**SQL, **sql})
