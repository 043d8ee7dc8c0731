"""The queries of this subpackage by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from geoframe.llm.audio import op6_audio
from geoframe.llm.chat import OP1_SQL, op1_chat
from geoframe.llm.html import op4_density
from geoframe.llm.infill import OP13_SQL, op13_infill
from geoframe.llm.language import op12_language
from geoframe.llm.mixing import op3_mixing
from geoframe.llm.packing import op9_packing
from geoframe.llm.quality import OP2_SQL, op2_quality
from geoframe.llm.simhash import op5_simhash
from geoframe.llm.suffix import op8_suffix
from geoframe.llm.tokens import op7_separators
from geoframe.llm.warc import OP10_SQL, op10_warc
from geoframe.llm.whitening import op11_whitening

QUERIES = {
    "op1_chat": op1_chat,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_density": op4_density,
    "op5_simhash": op5_simhash,
    "op6_audio": op6_audio,
    "op7_separators": op7_separators,
    "op8_suffix": op8_suffix,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_language": op12_language,
    "op13_infill": op13_infill,
}

ORACLE = {
    "op1_chat": OP1_SQL,
    "op2_quality": OP2_SQL,
    "op10_warc": OP10_SQL,
    "op13_infill": OP13_SQL,
}
