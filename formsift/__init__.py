"""Form extraction and review over tables of OCR text, as Spark jobs."""
