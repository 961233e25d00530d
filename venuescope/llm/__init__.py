"""Training-data operators on Spark: near-duplicates, line and passage dedup,
token counts, packing, language id, byte-level BPE, quality rules, language-model
scores and embedding near-duplicates.  Nothing else in the library imports this
package."""
