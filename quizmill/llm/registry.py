"""Queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from .chosen_path import op7_chosen_path_near_dedup
from .decontaminate import op5_suffix_automaton_decontamination
from .language import op8_mixture_language_id
from .lattice import op6_e8_lattice_near_dedup
from .line_dedup import OP4_SQL, op4_site_spread_line_dedup
from .merkle import OP12_SQL, op12_recursive_merkle_manifest
from .packing import op1_best_fit_packing
from .paragraph_dedup import op9_banded_paragraph_dedup
from .personal_data import op10_semi_markov_personal_data
from .suffix_dedup import op3_suffix_interval_dedup
from .token_counts import op11_digest_token_counts
from .token_files import op2_simple8b_token_files
from .whitening import op13_lanczos_whitening

QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_simple8b_token_files, op3_suffix_interval_dedup, op4_site_spread_line_dedup,
    op5_suffix_automaton_decontamination, op6_e8_lattice_near_dedup, op7_chosen_path_near_dedup, op8_mixture_language_id,
    op9_banded_paragraph_dedup, op10_semi_markov_personal_data, op11_digest_token_counts,
    op12_recursive_merkle_manifest, op13_lanczos_whitening)}

ORACLE: dict[str, str] = {"op4_site_spread_line_dedup": OP4_SQL, "op12_recursive_merkle_manifest": OP12_SQL}
