"""Column functions: grammar of names, span arithmetic, pseudonyms."""
