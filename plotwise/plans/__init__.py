"""The listing job: cleaning, transformation, training, reports."""
