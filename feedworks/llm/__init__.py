"""Operations for large text collections: quality, language model, near and exact
duplicates, secrets, mixing and tokenising.  Nothing outside this package imports it."""
