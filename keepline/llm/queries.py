"""The queries of this subpackage and the SQL they are checked against."""

from .byte_bpe import op12_byte_bpe
from .chat import OP10_SQL, op10_chat_format
from .decontaminate import OP4_SQL, op4_decontaminate
from .html_text import op3_html_text
from .merkle import OP13_SQL, op13_merkle
from .near_dedup import op5_minhash_dedup
from .neighbours import op7_neighbours
from .pieces import op1_sentencepiece
from .private_data import op6_private_data
from .quality import op2_quality
from .repeats import op8_repeats
from .token_counts import op9_token_counts
from .whitening import op11_whitening

QUERIES = {f.__name__: f for f in (
    op1_sentencepiece, op2_quality, op3_html_text, op4_decontaminate, op5_minhash_dedup,
    op6_private_data, op7_neighbours, op8_repeats, op9_token_counts, op10_chat_format,
    op11_whitening, op12_byte_bpe, op13_merkle)}
CHECKS = {"op4_decontaminate": OP4_SQL, "op10_chat_format": OP10_SQL, "op13_merkle": OP13_SQL}
