"""Fixed values, stated as the published code lists give them."""

# Production type codes of the European electricity transparency platform.
PRODUCTION_TYPES = {
    "B01": "Biomass",
    "B02": "Fossil Brown coal/Lignite",
    "B04": "Fossil Gas",
    "B05": "Fossil Hard coal",
    "B06": "Fossil Oil",
    "B09": "Geothermal",
    "B10": "Hydro Pumped Storage",
    "B11": "Hydro Run-of-river",
    "B12": "Hydro Water Reservoir",
    "B14": "Nuclear",
    "B15": "Other renewable",
    "B16": "Solar",
    "B17": "Waste",
    "B18": "Wind Offshore",
    "B19": "Wind Onshore",
    "B20": "Other",
    "B25": "Energy storage",
}

# Board power in watts, and the accelerator behind a cloud instance type.
ACCELERATOR_TDP_WATTS = {
    "NVIDIA H100 SXM5 80GB": 700.0,
    "NVIDIA T4": 70.0,
}
INSTANCE_ACCELERATORS = {
    "NC24ads_A100_v4": "NVIDIA A100 PCIe 80GB",
}

# Keys that may hold the record list of an API response, in order of preference.
ENVELOPE_KEYS = ("data", "results", "items", "records")
