"""Training-data operators: quality, near-duplicates, language model, secrets,
decontamination, personal data, token files, URLs, chat windows and mixing.

Nothing else in the library imports this subpackage.
"""
