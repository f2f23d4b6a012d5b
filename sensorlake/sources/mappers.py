"""Provider name tables.

Fixed values: identifiers, names and vocabulary terms as the providers use them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SNOTEL_VARIABLES_COLUMNS = ('id', 'clean_name', 'cv_term')
SNOTEL_VARIABLES = (
    ('PREC_m', 'precipitation', 'rainPrecipitation'),
    ('SNWD_H', 'snow_depth', 'snowThickness'),
    ('SRADV_H', 'global_radiation', 'solarRadiationIncomingBroadband'),
    ('TOBS_H', 'temperature', 'airTemperature'),
    ('WDIRV_H', 'wind_direction', 'windDirection'),
    ('WSPDV_H', 'wind_speed', 'windSpeed'),
    ('WTEQ_H', 'snow_water_equivalent', 'snowWaterEquivalent'),
    ('PRCPSA_D', 'precipitation_snow_adjusted', 'rainPrecipitationSnowAdjusted'),
)

SNOTEL_UNITS_COLUMNS = ('clean_name', 'abbreviation', 'cv_term')
SNOTEL_UNITS = (
    ('degf', 'degF', 'degreeFahrenheit'),
    ('in', 'in', 'inch'),
    ('v', 'V', 'volt'),
    ('mph', 'mph', 'milePerHour'),
    ('deg', 'deg', 'degree'),
    ('w_m2', 'W/m^2', 'wattPerSquareMeter'),
)

NWIS_COLUMNS = ('id', 'clean_name', 'cv_term', 'unit', 'cv_unit')
NWIS = (
    ('00010', 'temperature', 'waterTemperature', 'degrees Celsius', 'degreeCelsius'),
    ('00020', 'temperature_air', 'airTemperature', 'degrees Celsius', 'degreeCelsius'),
    ('00400', 'ph_water_unfiltered_field', 'waterpH', 'standard units', 'ph'),
    ('00045', 'precipitation', 'rainPrecipitation', 'inches', 'inch'),
    ('00060', 'discharge', 'waterStreamDischarge', 'cubic feet per second', 'cubicFootPerSecond'),
    ('00065', 'gage_height', 'waterHeightAboveSensor', 'feet', 'foot'),
    ('00095', 'water_specific_conductance', 'waterSpecificConductance', 'microsiemens per centimeter at 25 degrees Celsius', 'microsiemenPerCentimeter'),
    ('63675', 'water_turbidity_unfiltered_ntu', 'waterTurbidityNTU', 'nephelometric turbidity units', 'nephelometricTurbidityUnit'),
    ('63680', 'water_turbidity_unfiltered_fnu', 'waterTurbidity', 'formazin nephelometric units', 'formazinNephelometricUnit'),
    ('70969', 'dcp_battery_voltage', 'batteryVoltage', 'volts', 'volt'),
)

HYDROVU_PARAMETERS_COLUMNS = ('id', 'nice_name', 'clean_name', 'cv_term')
HYDROVU_PARAMETERS = (
    ('10', 'Specific Conductivity', 'specific_conductivity', 'waterSpecificConductance'),
    ('11', 'Resistivity', 'resistivity', 'waterResistivity'),
    ('12', 'Salinity', 'salinity', 'waterSalinity'),
    ('13', 'Total Dissolved Solids', 'total_dissolved_solids', 'waterTotalDissolvedSolids'),
    ('14', 'Density', 'density', 'waterDensity'),
    ('16', 'Baro', 'baro', 'airAtmosphericPressureAbsolute'),
    ('17', 'pH', 'ph', 'waterpH'),
    ('18', 'pH MV', 'ph_mv', 'waterpHmv'),
    ('19', 'ORP', 'orp', 'waterORP'),
    ('1', 'Temperature', 'temperature', 'waterTemperature'),
    ('45', 'Pulse', 'pulse', 'pulse'),
    ('2', 'Pressure', 'pressure', 'waterPressureAbsolute'),
    ('3', 'Depth', 'depth', None),
    ('4', 'Level: Depth to Water', 'level_depth_to_water', 'waterDepthBelowTopOfCasing'),
    ('9', 'Actual Conductivity', 'actual_conductivity', 'waterElectricalConductivity'),
    ('20', 'DO', 'do', 'waterOpticalDissolvedOxygen'),
    ('21', '% Saturation O₂', 'percent_saturation_o2', 'waterOpticalDissolvedOxygenPercentAirSaturation'),
    ('25', 'Turbidity', 'turbidity', 'waterTurbidityNTU'),
    ('30', 'Partial Pressure O₂', 'partial_pressure_o2', 'partialPressureOxygen'),
    ('32', 'External Voltage', 'external_voltage', 'externalVoltage'),
    ('33', 'Battery Level', 'battery_level', 'batteryCharge'),
    ('density', 'Density', 'density', 'waterDensity'),
    ('5', 'Level: Elevation', 'level_elevation', None),
)

HYDROVU_UNITS_COLUMNS = ('id', 'nice_name', 'clean_name', 'cv_term')
HYDROVU_UNITS = (
    ('194', 'NTU', 'ntu', 'nephelometricTurbidityUnit'),
    ('117', 'mg/L', 'mg_l', 'milligramPerLiter'),
    ('97', 'psu', 'psu', 'practicalSalinityUnit'),
    ('17', 'psi', 'psi', 'psi'),
    ('163', 'V', 'v', 'volt'),
    ('241', '%', 'percent', 'percent'),
    ('1', 'C', 'c', 'degreeCelsius'),
    ('322', 'Hz', 'hz', 'hertz'),
    ('129', 'g/cm³', 'g_cm3', 'gramPerCubicCentimeter'),
    ('65', 'µS/cm', 'us_cm', 'microsiemenPerCentimeter'),
    ('177', '% sat', 'percent_sat', 'percentSaturation'),
    ('35', 'm', 'm', 'meter'),
    ('145', 'pH', 'ph', 'ph'),
    ('81', 'Ω-cm', 'ohm_cm', 'ohmCentimeter'),
)

DECAGON_VARIABLES_COLUMNS = ('var_name', 'cv_term')
DECAGON_VARIABLES = (
    ('Wind Direction', 'windDirection'),
    ('Wind Speed', 'windSpeed'),
    ('Matric Potential', 'soilWaterPotential'),
    ('Soil Temperature', 'soilTemperature'),
    ('Water Content', 'soilVolumetricWaterContent'),
    ('Saturation Extract EC', 'soilElectricalConductivity'),
    ('Solar Radiation', 'solarRadiationIncomingBroadband'),
    ('Precipitation', 'rainPrecipitation'),
    ('Air Temperature', 'airTemperature'),
    ('Battery Voltage', 'batteryVoltage'),
    ('Battery Percent', 'batteryCharge'),
    ('Temperature', 'soilTemperature'),
    ('atmospheric_pressure', 'airAtmosphericPressureAbsolute'),
    ('Gust Speed', 'gustSpeed'),
    ('Lightning Activity', 'lightningActivity'),
    ('Lightning Distance', 'lightningDistance'),
    ('Max Precip Rate', 'rainPrecipitationRate'),
    ('RH Sensor Temp', 'systemTemperature'),
    ('Vapor Pressure', 'airVaporPressure'),
    ('VPD', 'airVaporPressureDeficit'),
    ('X-axis Level', 'instrumentOrientationX'),
    ('Y-axis Level', 'instrumentOrientationY'),
)

DECAGON_UNITS_COLUMNS = ('unit_name', 'cv_term')
DECAGON_UNITS = (
    ('°C', 'degreeCelsius'),
    ('mS/cm', 'millisiemenPerCentimeter'),
    ('m³/m³', 'cubicMeterPerCubicMeter'),
    ('kPa', 'kiloPascal'),
    ('km', 'kilometer'),
    ('mm/h', 'millimeterPerHour'),
    ('mm', 'millimeter'),
    ('W/m²', 'wattPerSquareMeter'),
    ('°', 'degree'),
    ('m/s', 'meterPerSecond'),
    ('%', 'percent'),
    ('mV', 'millivolt'),
    ('', 'unknown'),
)

REMARKS_COLUMNS = ('remark_cd', 'censor_cv')
REMARKS = (
    ('<', 'lessThan'),
    ('>', 'greaterThan'),
    ('A', 'average'),
    ('E', 'estimated'),
    ('M', 'presentButNotQuantified'),
    ('N', 'presumptiveEvidenceOfPresence'),
    ('S', 'mostProbableValue'),
    ('U', 'analyzedForNonDetect'),
    ('V', 'contamination'),
)

QUALIFIERS_COLUMNS = ('val_qual_cd', 'val_qual_nm')
QUALIFIERS = (
    ('$', 'incorrect sample container'),
    ('&', 'biological organism estimated as dominant'),
    ('(', 'blank greater than the sample-specific Critical Level'),
    (')', 'sample-specific MDC (ssMDC) above contractual MDC'),
    ('*', 'sample was warm when received'),
    ('+', 'improper preservation'),
    ('/', 'matrix spike (MS) recovery outside of acceptable range'),
    ('=', 'negative result may indicate potential negative bias'),
    ('@', 'holding time exceeded'),
    ('a', 'value extrapolated at high end'),
    ('b', 'value extrapolated at low end'),
    ('c', 'see result laboratory comment'),
    ('d', 'sample was diluted'),
    ('e', 'see result field comment'),
    ('f', 'sample field preparation problem'),
    ('g', 'count less than 0.5 percent'),
    ('h', 'compound identification verified by alternate method'),
    ('i', 'result may be affected by interference'),
    ('j', 'count greater than or equal to 15 percent (dominant)'),
    ('k', 'counts outside acceptable range'),
    ('l', 'sample preparation problem'),
    ('m', 'value is highly variable by this method'),
    ('n', 'below the reporting level but at or above the detection level'),
    ('o', 'result determined by alternate method'),
    ('p', 'value reported is preferred'),
    ('q', 'insufficient sample received'),
    ('r', 'value verified by rerun, same method'),
    ('s', 'instrument sensitivity problem'),
    ('t', 'below the detection level'),
    ('u', 'value reported not confirmable, interference'),
    ('v', 'analyte detected in laboratory blank'),
    ('w', 'high variability, questionable precision and accuracy'),
    ('x', 'interference from sample matrix'),
    ('y', 'sample variability described in comment'),
    ('z', 'value verified by rerun, alternate method'),
    ('\\', 'lab control sample (LCS) recovery outside of range or criteria'),
    ('^', 'yield outside of contractually acceptable range'),
    ('~', 'duplicates do not check (not within the acceptance limits)'),
)


def table(spark: SparkSession, columns: tuple[str, ...], rows: tuple[tuple, ...]) -> DataFrame:
    """A name table as a frame of strings; a literal relation, so its size is known to the optimizer."""
    def literal(value) -> str:
        if value is None:
            return "CAST(NULL AS STRING)"
        text = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")
