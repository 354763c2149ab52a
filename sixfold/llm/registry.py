"""The queries of this package: name -> (build DataFrame from a session and a data folder, the same result as SQL or None)."""

from sixfold.llm import chat, decontaminate, html, jaccard, language, lines, manifest, mixing, negatives, quality, repeats, toxicity, urls

QUERIES = {}
for _part in (toxicity, html, quality, jaccard, mixing, decontaminate, repeats, lines, language, urls, manifest, negatives, chat):
    QUERIES |= _part.QUERIES
