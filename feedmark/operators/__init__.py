"""Jobs over tables of any size."""
