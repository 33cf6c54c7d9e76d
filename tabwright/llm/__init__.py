"""Training-data operators: near-duplicates, decontamination, licences, repeats, personal data, token files,
toxicity, packing and quality. Nothing outside this folder and ``corpus_pipeline.py`` imports it."""
