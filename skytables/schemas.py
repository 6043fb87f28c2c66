"""Declared schemas. Unsigned source types are widened one step; every field is nullable."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "SMALLINT": T.ShortType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "FLOAT": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
}
_TYPES |= {f"ARRAY<{name}>": T.ArrayType(type_) for name, type_ in list(_TYPES.items())}


def _schema(columns: str) -> T.StructType:
    """``name TYPE [NOT NULL], ...``; unlike ``StructType.fromDDL`` this needs no session, so it works at import."""
    fields = []
    for column in columns.split(","):
        name, type_name, *not_null = column.split()
        fields.append(T.StructField(name, _TYPES[type_name], nullable=not not_null))
    return T.StructType(fields)


RAW_LIGHTCURVES = _schema(
    """objectid BIGINT, filterid SMALLINT, fieldid INT, rcid SMALLINT, objra FLOAT, objdec FLOAT, nepochs BIGINT,
    hmjd ARRAY<DOUBLE>, mag ARRAY<FLOAT>, magerr ARRAY<FLOAT>, clrcoeff ARRAY<FLOAT>, catflags ARRAY<INT>"""
)

OBSERVATIONS = _schema(
    """oid BIGINT, nobs INT, band SMALLINT, fieldid INT, rcid SMALLINT, ra DOUBLE, dec DOUBLE, cell BIGINT,
    mjd DOUBLE, mag FLOAT, magerr FLOAT, clrcoeff FLOAT, catflags INT"""
)

# The positional columns of the PS1 object-mean table; five bands repeat one block of sixteen.
_OTMO_OBJECT = """
    objName STRING, objNameHMS STRING, objAltName1 STRING, objAltName2 STRING, objAltName3 STRING,
    objPopularName STRING, objID BIGINT, uniquePspsOBid BIGINT, ippObjID BIGINT, surveyID SMALLINT, htmID BIGINT,
    zoneID INT, tessID SMALLINT, projectionID SMALLINT, skyCellID SMALLINT, randomID DOUBLE, batchID BIGINT,
    dvoRegionID INT, processingVersion SMALLINT, objInfoFlag INT, astrometryCorrectionFlag SMALLINT,
    qualityFlag SMALLINT, raStack DOUBLE, decStack DOUBLE, raStackErr FLOAT, decStackErr FLOAT, raMean DOUBLE,
    decMean DOUBLE, raMeanErr DOUBLE, decMeanErr DOUBLE, pmra DOUBLE, pmdec DOUBLE, pmraErr DOUBLE, pmdecErr DOUBLE,
    epochMean DOUBLE, posMeanChisq DOUBLE, cx DOUBLE, cy DOUBLE, cz DOUBLE, lambda DOUBLE, beta DOUBLE, l DOUBLE,
    b DOUBLE, nStackObjectRows SMALLINT, nStackDetections SMALLINT, nDetections SMALLINT"""
_OTMO_BANDS = "grizy"
_OTMO_BAND_BLOCK = """
    {0}QfPerfect FLOAT, {0}MeanPSFMag FLOAT, {0}MeanPSFMagErr FLOAT, {0}MeanPSFMagStd FLOAT, {0}MeanPSFMagNpt SMALLINT,
    {0}MeanPSFMagMin FLOAT, {0}MeanPSFMagMax FLOAT, {0}MeanKronMag FLOAT, {0}MeanKronMagErr FLOAT,
    {0}MeanKronMagStd FLOAT, {0}MeanKronMagNpt SMALLINT, {0}MeanApMag FLOAT, {0}MeanApMagErr FLOAT,
    {0}MeanApMagStd FLOAT, {0}MeanApMagNpt SMALLINT, {0}Flags INT"""
OTMO = _schema(
    ", ".join(
        [_OTMO_OBJECT]
        + [f"n{band} SMALLINT" for band in _OTMO_BANDS]
        + [_OTMO_BAND_BLOCK.format(band) for band in _OTMO_BANDS]
    )
)

# The columns of the star-galaxy-quasar classification table, with the class domain.
STRM = _schema(
    """objID BIGINT, uniquePspsOBid BIGINT, raMean DOUBLE, decMean DOUBLE, l DOUBLE, b DOUBLE, class STRING,
    prob_Galaxy DOUBLE, prob_Star DOUBLE, prob_QSO DOUBLE, extrapolation_Class INT, cellDistance_Class DOUBLE,
    cellID_Class INT, z_phot DOUBLE, z_photErr DOUBLE, z_phot0 DOUBLE, extrapolation_Photoz INT,
    cellDistance_Photoz DOUBLE, cellID_Photoz INT"""
)
STRM_CLASSES = ("GALAXY", "STAR", "QSO", "UNSURE")

# The columns of the 2MASS point source catalogue, from its published format page.
PSC = _schema(
    """ra DOUBLE, dec DOUBLE, err_maj FLOAT, err_min FLOAT, err_ang SMALLINT, designation STRING,
    j_m FLOAT, j_cmsig FLOAT, j_msigcom FLOAT, j_snr FLOAT, h_m FLOAT, h_cmsig FLOAT, h_msigcom FLOAT, h_snr FLOAT,
    k_m FLOAT, k_cmsig FLOAT, k_msigcom FLOAT, k_snr FLOAT, ph_qual STRING, rd_flg STRING, bl_flg STRING,
    cc_flg STRING, ndet STRING, prox FLOAT, pxpa SMALLINT, pxcntr INT, gal_contam SMALLINT, mp_flg SMALLINT,
    pts_key INT, hemis STRING, date STRING, scan SMALLINT, glon FLOAT, glat FLOAT, x_scan FLOAT, jdate DOUBLE,
    j_psfchi FLOAT, h_psfchi FLOAT, k_psfchi FLOAT, j_m_stdap FLOAT, j_msig_stdap FLOAT, h_m_stdap FLOAT,
    h_msig_stdap FLOAT, k_m_stdap FLOAT, k_msig_stdap FLOAT, dist_edge_ns INT, dist_edge_ew INT,
    dist_edge_flg STRING, dup_src SMALLINT, use_src SMALLINT, a STRING, dist_opt FLOAT, phi_opt SMALLINT,
    b_m_opt FLOAT, vr_m_opt FLOAT, nopt_mchs SMALLINT, ext_key INT, scan_key INT, coadd_key INT, coadd SMALLINT"""
)

# The published verification sums of the 2MASS point source catalogue.
PSC_CONTROL_SUMS = {
    "rows": 470992970,
    "pts_key": 306810325437475788,
    "pxcntr": 306815556538478936,
    "scan_key": 16902776758555,
    "scan": 32666066948,
    "ext_key": 2048692118201,
    "coadd_key": 388758631396659,
    "coadd": 64617139213,
    "mp_flg": 16048,
    "gal_contam": 729878,
    "use_src": 464456155,
    "dup_src": 79798372,
    "nopt_mchs": 369187043,
    "phi_opt": 64916239773,
    "dist_edge_ew": 69388217174,
    "dist_edge_ns": 2670725813652,
    "err_ang": 29279563815,
}

# Exposure columns; those marked NOT NULL may not hold a null.
EXPOSURES = _schema(
    """expid BIGINT NOT NULL, field INT NOT NULL, band STRING NOT NULL, ra DOUBLE NOT NULL, dec DOUBLE NOT NULL,
    exptime FLOAT NOT NULL, airmass FLOAT NOT NULL, infobits SMALLINT, dr SMALLINT, numsci SMALLINT, numdiff SMALLINT,
    fwhm FLOAT, maglim FLOAT, scibckgnd FLOAT, ellip FLOAT, ellippa FLOAT, obsdate STRING NOT NULL"""
)
EXPOSURE_BANDS = ("g", "r", "i")

# First and last MJD of the survey-internal period of each early data release.
PRIVATE_INTERVALS = {2: (58194.0, 58299.0), 3: (58194.0, 58483.0), 4: (58194.0, 58664.0)}

# Light-curve band numbers.
BAND_NUMBERS = {"g": 1, "r": 2, "i": 3}
