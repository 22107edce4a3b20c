"""The queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from . import chat, collocations, lines
from .chat import op9_chat
from .collocations import op12_collocations
from .decontamination import op7_decontamination
from .licenses import op5_licenses
from .lines import op11_line_dedup
from .packing import op6_packing
from .quality import op10_quality
from .secrets import op3_secrets
from .sharding import op1_sharding
from .simhash import op2_simhash
from .spelling import op13_spelling
from .substrings import op4_suffix_dedup
from .toxicity import op8_toxicity

QUERIES = {f.__name__: f for f in (op1_sharding, op2_simhash, op3_secrets, op4_suffix_dedup, op5_licenses, op6_packing, op7_decontamination, op8_toxicity, op9_chat, op10_quality, op11_line_dedup, op12_collocations, op13_spelling)}
ORACLE: dict[str, str] = {"op9_chat": chat.ORACLE_SQL, "op11_line_dedup": lines.ORACLE_SQL, "op12_collocations": collocations.ORACLE_SQL}
