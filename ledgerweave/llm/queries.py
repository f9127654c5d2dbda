"""The registered queries of this subpackage: name -> (function of session and data folder, SQL)."""

from __future__ import annotations

from ledgerweave.llm import (cgk, chunks, extendible, hyperminhash, langid, licenses, nndescent,
                             poisson, spelling, triescore, urlfilter, wavelet, whitening)

QUERIES = {
    "op1_url_filter": (urlfilter.op1_url_filter, None),
    "op2_nn_descent": (nndescent.op2_nn_descent, None),
    "op3_hyperminhash": (hyperminhash.op3_hyperminhash, None),
    "op4_extendible_shards": (extendible.op4_extendible_shards, extendible.OP4_SQL),
    "op5_gear_chunks": (chunks.op5_gear_chunks, None),
    "op6_wavelet_tokens": (wavelet.op6_wavelet_tokens, None),
    "op7_elias_fano_trie": (triescore.op7_elias_fano_trie, None),
    "op8_language_id": (langid.op8_language_id, None),
    "op9_poisson_mix": (poisson.op9_poisson_mix, poisson.OP9_SQL),
    "op10_decontaminate": (cgk.op10_decontaminate, None),
    "op11_whitening": (whitening.op11_whitening, None),
    "op12_license_scan": (licenses.op12_license_scan, licenses.OP12_SQL),
    "op13_spelling_variants": (spelling.op13_spelling_variants, None),
}
