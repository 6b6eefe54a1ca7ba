"""Operations for text corpora and free-typed vocabularies; nothing else in the library depends on them."""
