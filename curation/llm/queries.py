"""The registered queries of this package and their SQL."""

from __future__ import annotations

from .archive import OP8_SQL, op8_warc_archive
from .conversations import op11_conversation_repair
from .decontaminate import OP10_SQL, op10_decontamination
from .itq import op9_embedding_dedup
from .licenses import OP2_SQL, op2_license_scan
from .main_text import OP12_SQL, op12_main_text
from .packing import op1_packing
from .pii import op3_personal_data
from .relative_lz import op5_substring_dedup
from .resample import op13_resample
from .simhash import op6_simhash
from .token_counts import op7_token_counts
from .toxicity import op4_toxicity

QUERIES = {
    "op1_packing": op1_packing,
    "op2_license_scan": op2_license_scan,
    "op3_personal_data": op3_personal_data,
    "op4_toxicity": op4_toxicity,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_simhash": op6_simhash,
    "op7_token_counts": op7_token_counts,
    "op8_warc_archive": op8_warc_archive,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_main_text": op12_main_text,
    "op13_resample": op13_resample,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES = {
    "op2_license_scan": OP2_SQL,
    "op8_warc_archive": OP8_SQL,
    "op10_decontamination": OP10_SQL,
    "op12_main_text": OP12_SQL,
}
