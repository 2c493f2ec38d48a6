"""Weights of the segment model, written by pii_training."""

#: What training gave.
TRAINED: dict[str, float] = {
    "address:before": 0.889,
    "address:before1": 0.889,
    "address:bias": 0.688,
    "address:cell": 1.619,
    "address:english": 0.581,
    "address:french": 0.349,
    "address:german": 0.092,
    "address:more": -1.539,
    "address:none": -2.328,
    "address:postcode": 1.434,
    "address:romance": 0.235,
    "address:state": 2.008,
    "address:town": -1.447,
    "address:townstate": -0.887,
    "email:bias": 1.445,
    "email:cell": 1.722,
    "email:evading": 1.228,
    "email:login": -3.792,
    "email:plain": 1.29,
    "id:beside": 0.747,
    "id:cpf": 0.863,
    "id:digits": -1.761,
    "id:dni": 0.405,
    "id:label": 2.876,
    "id:nino": 0.927,
    "id:nir": 0.395,
    "id:pass": 0.515,
    "id:pesel": 0.536,
    "id:ssn": 0.41,
    "id:tax": 0.247,
    "id:valid": 0.439,
    "id_number:bias": -0.802,
    "id_number:cell": -1.761,
    "name:agent": 1.574,
    "name:article": -2.18,
    "name:bias": 2.638,
    "name:caps": 1.865,
    "name:caps1": 1.757,
    "name:cell": 1.156,
    "name:comma": 5.541,
    "name:comma1": 5.529,
    "name:common": -0.905,
    "name:cue": 0.488,
    "name:double": 0.713,
    "name:full": 0.666,
    "name:given": 2.717,
    "name:givenlast": -1.085,
    "name:glued": -0.033,
    "name:heading": 0.448,
    "name:initials": -3.649,
    "name:join": -1.756,
    "name:label": 3.943,
    "name:middle": 0.288,
    "name:noun": -1.667,
    "name:oddmiddle": -0.72,
    "name:other": -0.862,
    "name:titled": 0.553,
    "name:unheard": -1.568,
    "name:unheard:double": 0.106,
    "name:unheard:full": -1.61,
    "name:unheard:initials": -0.828,
    "name:unheard:middle": 0.611,
    "name:unknown": 0.806,
    "phone:area": 1.072,
    "phone:bias": 1.176,
    "phone:cell": 1.317,
    "phone:label": -0.169,
    "phone:pairs": -0.279,
    "phone:plus": 1.414,
    "phone:three": -0.709,
    "phone:trunk": -0.461,
    "phone:zeros": 0.804,
}
