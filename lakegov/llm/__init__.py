"""Training-data operators over whole text corpora.

Thirteen operators (quality resampling, token counts, risk-controlled rules,
toxicity, suffix-array / line / SimHash deduplication, source mixing,
benchmark decontamination, chat formatting, cross-tokenizer alignment,
conversation prefix trie, language identification), their registered queries
(``catalog``) and shared helpers. Nothing else in the library imports this
subpackage.
"""
