"""Training-data operators: chat, HTML, scoring, language, decontamination, packing, URLs, shards,
near copies. Nothing else in the library imports this subpackage."""
