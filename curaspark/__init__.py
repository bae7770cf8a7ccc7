"""curaspark: curation of DNA-barcode reference records as Spark DataFrames."""

__version__ = "0.1.0"
