"""Training-data operators: quality, licences, language, tokens, toxicity,
near duplicates, language models, decontamination and web archives.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames, reads only the columns it names (other columns never clash
with its own), and defines its result for nulls, empty and very long texts,
repeated rows and empty tables in its docstring.
"""
