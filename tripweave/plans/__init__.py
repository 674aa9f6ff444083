"""Named reports over prepared trips, and the batch run that chains them."""
