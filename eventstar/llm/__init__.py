"""Operations of a training-data pipeline: cleaning, deduplication, scoring,
decontamination, archives and packing.  Nothing else in the library imports
this package."""
